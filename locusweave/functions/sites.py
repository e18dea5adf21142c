"""Columns over sites, alleles, sample ids and calls. Everything is built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Chromosomes in genomic order, and ancestry codes.
CHROMOSOMES = [*map(str, range(1, 23)), "X", "Y", "MT"]
ANCESTRIES = ["AAC", "AFR", "AJ", "AMR", "CAH", "CAS", "EAS", "EUR", "FIN", "MDE", "SAS"]

#: A call of at least HET is a carrier's, of at least HOM homozygous.
HET, HOM = 0.5, 1.5


def col(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def chromosome(x: str | Column) -> Column:
    """Without spaces and ``chr``, in upper case."""
    return F.regexp_replace(F.upper(F.trim(col(x))), "CHR", "")


def prefixed_chromosome(x: str | Column) -> Column:
    """With ``chr`` in front."""
    return F.when(col(x).startswith("chr"), col(x)).otherwise(F.concat(F.lit("chr"), col(x)))


def allele(x: str | Column) -> Column:
    return F.upper(F.trim(col(x)))


def complement(x: str | Column) -> Column:
    """The other strand's letter; strings of several letters stay as they are."""
    return F.when(F.length(col(x)) == 1, F.translate(col(x), "ACGT", "TGCA")).otherwise(col(x))


def is_strand_ambiguous(ref: str | Column, alt: str | Column) -> Column:
    """True for A/T and C/G sites."""
    return F.concat(col(ref), col(alt)).isin("AT", "TA", "CG", "GC")


def chromosome_rank(x: str | Column) -> Column:
    """Place in genomic order; 99 for an unknown chromosome."""
    found = F.array_position(F.array(*map(F.lit, CHROMOSOMES)), col(x)).cast("int")
    return F.when(found > 0, found).otherwise(99)


def normalized_sample_id(x: str | Column) -> Column:
    """Without one leading ``0_``; of an id made of two equal halves (an even number of four or more parts), one half."""
    plain = F.regexp_replace(col(x), "^0_", "")
    parts = F.split(plain, "_")
    n = F.size(parts)
    half = F.floor(n / 2).cast("int")
    left, right = F.slice(parts, 1, half), F.slice(parts, half + 1, half)
    return F.when((n >= 4) & (n % 2 == 0) & (left == right), F.array_join(left, "_")).otherwise(plain)


def call_class(dosage: str | Column, het: float = HET, hom: float = HOM) -> Column:
    """``hom``, ``het``, ``ref`` or null for a missing call."""
    d = col(dosage)
    return F.when(d >= hom, "hom").when(d >= het, "het").when(d.isNotNull(), "ref")


def zygosity(dosage: str | Column) -> Column:
    """Label of a carrier's call: empty if missing."""
    d = col(dosage)
    return F.when(d.isNull(), "").when(d >= HOM, "hom").otherwise("het")


def genotype_string(dosage: str | Column, letter: str | Column) -> Column:
    """Genotype text where the dosage counts reference alleles."""
    d = col(dosage).cast("int")
    a = col(letter)
    return F.when(d.isNull(), "./.").when(d == 2, "WT/WT").when(d == 1, F.concat(F.lit("WT/"), a)).when(d == 0, F.concat_ws("/", a, a)).otherwise(":/:")


def gt_code(gt: str | Column) -> Column:
    """Count of the alternative allele in a VCF call; -9 for anything else."""
    g = col(gt)
    return F.when(g == "0/0", 0).when(g.isin("0/1", "1/0"), 1).when(g == "1/1", 2).otherwise(-9)


def allele_pair(dosage: str | Column, counted: str | Column, alt: str | Column) -> Column:
    """Two letters of a call; ``NN`` if missing."""
    d, c, a = col(dosage), col(counted), col(alt)
    return F.when((d >= 0) & (d < HET), F.concat(a, a)).when((d >= HET) & (d < HOM), F.concat(c, a)).when(d >= HOM, F.concat(c, c)).otherwise("NN")


def ancestry(data_type: str | Column, nba: str | Column, wgs: str | Column) -> Column:
    """Label of a sample for a data type."""
    t = col(data_type)
    return F.when(t == "WGS", col(wgs)).when(t == "EXOMES", F.coalesce(col(nba), col(wgs), F.lit("Unknown"))).otherwise(col(nba))


def probe_type(name: str | Column) -> Column:
    """Kind of an array probe by its name; the first rule that fits counts."""
    n = F.lower(col(name))
    return (
        F.when(n.contains("seq_"), "sequencing").when(n.contains("ilmn"), "illumina_array").when(n.contains("chr") & n.contains(":"), "coordinate_based").when(n.contains("nm_") | n.contains("hgvs"), "transcript_based").otherwise("unknown")
    )


def ratio(a: Column, b: Column) -> Column:
    """a / b, 0 where b is 0 or null."""
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def count_if(x: Column) -> Column:
    return F.count_if(F.coalesce(x, F.lit(False)))
