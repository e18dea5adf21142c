"""VCF text lines to typed columns, regions, and the merge of many inputs by site."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusweave.functions import sites as s
from locusweave.sources import matrix

FIXED = ["chromosome", "position", "variant_id", "ref", "alt", "qual", "filter", "info", "format", "sample"]


def normalized(rows: DataFrame) -> DataFrame:
    """Chromosomes without ``chr``, positions as numbers."""
    return rows.withColumns({"chromosome": F.regexp_replace("chromosome", "^chr", ""), "position": F.expr("try_cast(position AS BIGINT)")})


def records(lines: DataFrame, *keep: str) -> DataFrame:
    """Records of one-sample VCF lines (column value), with the columns ``keep`` of the lines; header lines are left out."""
    part = F.split("value", "\t")
    rows = lines.where(~F.col("value").startswith("#") & (F.trim("value") != "")).select(*(F.get(part, F.lit(i)).alias(c) for i, c in enumerate(FIXED)), *keep)
    return normalized(rows)


def format_field(key: str) -> Column:
    """Value of a FORMAT key in the sample column, by the record's own FORMAT; '.' and absent keys are null."""
    at = F.array_position(F.split("format", ":"), F.lit(key)).cast("int")
    return F.nullif(F.get(F.split("sample", ":"), F.nullif(at, F.lit(0)) - 1), F.lit("."))


def info_field(key: str) -> Column:
    """Value of an INFO key, by its exact name."""
    return F.try_element_at(F.str_to_map("info", F.lit(";"), F.lit("=")), F.lit(key))


def sample_metrics(lines: DataFrame, *keep: str) -> DataFrame:
    """snpID with genotype code and the numbers GS, BAF and LRR."""
    return records(lines, *keep).select(*keep, F.col("variant_id").alias("snpID"), "chromosome", "position", s.gt_code(format_field("GT")).alias("GT"), *(format_field(k).try_cast("double").alias(k) for k in ("GS", "BAF", "LRR")))


def variant_reference(lines: DataFrame, info: tuple[str, ...] = ()) -> DataFrame:
    return records(lines).select("chromosome", "position", "variant_id", "ref", "alt", "qual", "filter", "info", *(info_field(k).alias(k) for k in info))


def allele_columns(lines: DataFrame) -> DataFrame:
    """a1 and a2: the reference allele, or the alternative one where ALLELE_A or ALLELE_B is 1."""
    pick = lambda k: F.when(info_field(k) == "1", F.col("alt")).otherwise(F.col("ref"))
    return records(lines).select("variant_id", pick("ALLELE_A").alias("a1"), pick("ALLELE_B").alias("a2"))


def extract_columns(lines: DataFrame, columns: list[str] | str = "all", rows: int | None = None, *keep: str) -> DataFrame:
    """Chosen columns with the id always first as snpID: ``all``, ``metadata``, ``sample`` or a list of names (fixed, INFO or FORMAT keys, a1 and a2). ``rows`` is a preview.

    ``keep`` (such as the sample's IID, which goes with its columns) are columns of the lines themselves.
    """
    known = {"metadata": FIXED[:8], "sample": ["GT", "GS", "BAF", "LRR"], "all": [*FIXED[:8], "GT", "GS", "BAF", "LRR"]}
    names = known[columns] if isinstance(columns, str) else columns
    alleles = {"a1": "ALLELE_A", "a2": "ALLELE_B"}
    out = [F.col("variant_id").alias("snpID"), *keep]
    for c in names:
        if c == "variant_id":
            continue
        if c in alleles:
            out.append(F.when(info_field(alleles[c]) == "1", F.col("alt")).otherwise(F.col("ref")).alias(c))
        else:
            out.append(F.col(c) if c in FIXED else F.coalesce(format_field(c), info_field(c)).alias(c))
    found = records(lines, *keep).select(*out)
    return found.limit(rows) if rows else found


def write_columns(found: DataFrame, path: str, form: str = "csv", partition_by_chromosome: bool = False) -> None:
    """Extracted columns as csv or parquet, by chromosome if they hold it and it is asked for; a task then writes a range of chromosome and id."""
    by = partition_by_chromosome and "chromosome" in found.columns
    writer = (found.repartitionByRange("chromosome", "snpID") if by else found).write.mode("overwrite")
    writer = writer.partitionBy("chromosome") if by else writer
    writer.option("header", True).csv(path) if form == "csv" else writer.format(form).save(path)


def parse_regions(lines: DataFrame) -> DataFrame:
    """chromosome, start, end of ``chr:start-end`` lines; comments and blank lines are left out."""
    form = r"^\s*(?:chr)?([^:\s#]+):(\d+)-(\d+)\s*$"
    part = lambda i: F.regexp_extract("value", form, i)
    return lines.where(F.col("value").rlike(form)).select(part(1).alias("chromosome"), part(2).cast("bigint").alias("start"), part(3).cast("bigint").alias("end"))


def region_restrict(sites: DataFrame, regions: DataFrame, bin_width: int = 1_000_000) -> DataFrame:
    """Sites that lie in any region (ends included).

    Positions and regions are dealt to bins, so the range join is an equi-join; a site in several regions comes once.
    """
    bins = F.sequence(F.floor(F.col("start") / bin_width), F.floor(F.col("end") / bin_width))
    r = regions.select(F.col("chromosome").alias("__c"), "start", "end", F.explode(bins).alias("__bin"))
    near = (F.col("chromosome") == F.col("__c")) & (F.floor(F.col("position") / bin_width) == F.col("__bin"))
    return sites.join(r, near & F.col("position").between(F.col("start"), F.col("end")), "left_semi")


#: Keys of a site.
SITE = ["chromosome", "position", "ref", "alt"]
#: Columns of a merged file before its samples.
MERGED = ["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT"]


def merge_sites(calls: DataFrame, samples: list[str], path: str, block: int = matrix.BLOCK, codec: str = "none") -> None:
    """A VCF file set of one record per site with all samples of all inputs, in genomic order; a sample without a call there has ``./.``.

    ``calls``: chromosome, position, ref, alt, sample_id, call. ``samples``: those of all headers, in order. Files begin with their ``#CHROM`` line; what goes above it is the caller's. Calls are gathered in blocks of samples, so no row holds a site's calls but the line itself.
    """
    dot = F.lit(".")
    values = (F.col("chromosome"), F.col("position"), dot, F.col("ref"), F.col("alt"), dot, F.lit("PASS"), dot, F.lit("GT"))
    order = [s.chromosome_rank("chromosome"), F.col("position"), F.col("ref"), F.col("alt")]
    matrix.write(calls, SITE, "sample_id", "call", samples, dict(zip(MERGED, values)), path, order, "./.", block, codec)


def genomic_sort(sites: DataFrame) -> DataFrame:
    """In genomic order: ranges over tasks, sorted within; the order of the output files."""
    return sites.orderBy(s.chromosome_rank("chromosome"), "position", "variant_id")
