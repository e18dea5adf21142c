"""Matching of variant lists to sites, harmonization of alleles, recoding of dosages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locusweave.functions import sites as s

#: Keys of a genotype row after harmonization.
KEYS = ["variant_id", "snp_list_id", "chromosome", "position", "counted_allele", "alt_allele"]


def normalize_sites(df: DataFrame) -> DataFrame:
    """Chromosome, position, ref and alt in normal form; rows without all four are dropped."""
    out = df.withColumns({"chromosome": s.chromosome("chromosome"), "position": F.expr("try_cast(position AS BIGINT)"), "ref": s.allele("ref"), "alt": s.allele("alt")})
    return out.dropna(subset=["chromosome", "position", "ref", "alt"])


def valid_variants(df: DataFrame) -> DataFrame:
    """Known chromosome, positive position, alleles of A, C, G and T."""
    return df.where(F.col("chromosome").isin(s.CHROMOSOMES) & (F.col("position") > 0) & F.col("ref").rlike("^[ATCG]+$") & F.col("alt").rlike("^[ATCG]+$"))


def site_join(pvar: DataFrame, snp_list: DataFrame) -> DataFrame:
    """All pairs of a site and a list row at one position. The list is the smaller side; Spark broadcasts it where its size allows."""
    listed = snp_list.select("snp_list_id", "gene", "chromosome", "position", F.col("ref").alias("list_ref"), F.col("alt").alias("list_alt"))
    return pvar.select("variant_id", "chromosome", "position", "ref", "alt").join(listed, ["chromosome", "position"])


def action() -> Column:
    """First match of EXACT, SWAP, FLIP and FLIP_SWAP, for columns ref, alt, list_ref, list_alt."""
    r, a, lr, la = (F.col(c) for c in ("ref", "alt", "list_ref", "list_alt"))
    fr, fa = s.complement(lr), s.complement(la)
    return F.when((r == lr) & (a == la), "EXACT").when((r == la) & (a == lr), "SWAP").when((r == fr) & (a == fa), "FLIP").when((r == fa) & (a == fr), "FLIP_SWAP")


def harmonize(pvar: DataFrame, snp_list: DataFrame) -> DataFrame:
    """Matches of sites and list rows with their action; sites that match no way are dropped."""
    matched = site_join(pvar, snp_list).withColumn("action", action()).where("action IS NOT NULL")
    return matched.withColumn("strand_ambiguous", s.is_strand_ambiguous("list_ref", "list_alt"))


def harmonize_by_key(pvar: DataFrame, snp_list: DataFrame, mode: str = "last") -> DataFrame:
    """Match by key equality: each list row stands for four keys. Of several entries of a key the ``last`` (or ``first``) counts."""
    lr, la = F.col("ref"), F.col("alt")
    ways = [("exact", lr, la), ("swap", la, lr), ("flip", s.complement(lr), s.complement(la)), ("flip_swap", s.complement(la), s.complement(lr))]
    entries = snp_list.select(
        "snp_list_id", "chromosome", "position", F.explode(F.array(*(F.struct(F.lit(i).alias("rank"), F.lit(n).alias("match"), r.alias("ref"), a.alias("alt")) for i, (n, r, a) in enumerate(ways)))).alias("w")
    ).select("snp_list_id", "chromosome", "position", "w.*")
    order = [F.col("snp_list_id"), F.col("rank")]
    if mode == "last":
        order = [c.desc() for c in order]
    keys = ["chromosome", "position", "ref", "alt"]
    best = entries.withColumn("n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("n = 1").drop("n", "rank")
    return pvar.join(best, keys).select("variant_id", "snp_list_id", *keys, "match")


def is_carrier(dosage: str = "dosage") -> Column:
    return F.coalesce(F.col(dosage) > 0, F.lit(False))


def dosage_transform(dosage: str | Column, formula: str | Column) -> Column:
    """``2-x`` turns a dosage around; any other formula leaves it; a missing call stays missing."""
    d = s.col(dosage)
    return F.when(s.col(formula) == "2-x", 2 - d).otherwise(d)


def harmonize_dosage(genotype: DataFrame, plan: DataFrame | None) -> DataFrame:
    """Dosages that count the list's alternative allele; a source variant with k list rows gives k rows.

    Every action turns the dosage around once. Without a plan the input is returned unchanged.
    """
    if plan is None:
        return genotype
    plan = plan.select("variant_id", "snp_list_id", "chromosome", "position", "action", F.col("list_ref"), F.col("list_alt"), "ref", "alt")
    known = F.col("action").isin("EXACT", "SWAP", "FLIP", "FLIP_SWAP")
    return (
        genotype.join(plan, "variant_id")
        .withColumn("dosage", dosage_transform("dosage", F.when(known, "2-x")))
        .withColumn("counted_allele", F.when(known, F.col("list_alt")).otherwise(F.col("ref")))
        .withColumn("alt_allele", F.when(known, F.col("list_ref")).otherwise(F.col("alt")))
        .select(*genotype.columns, "snp_list_id", "chromosome", "position", "action", "counted_allele", "alt_allele")
    )


def with_source(genotype: DataFrame, samples: DataFrame) -> DataFrame:
    """Genotypes with the ancestry whose file a sample's calls lie in, as ``source``, where the path doesn't tell it."""
    label = s.ancestry("data_type", "nba_label", "wgs_label")
    return genotype.join(samples.select("sample_id", "nba_label", "wgs_label"), "sample_id", "left").withColumn("source", F.coalesce(label, F.lit("Unknown"))).select(*genotype.columns, "source")


def maf_correction(genotype: DataFrame, *sources: str) -> DataFrame:
    """Turn variants around whose allele frequency in their source is over one half.

    A source is a file: one value of each column in ``sources``, by default of those of data_type and source (the ancestry) that are there. Sources are corrected each by itself, so one
    ancestry of a variant may be turned and another not.

    The frequencies are an aggregate of one row per variant that is joined back, so no window has to hold all samples of a variant.
    """
    sources = sources or tuple(c for c in ("data_type", "source") if c in genotype.columns)
    keys = [*sources, "variant_id", "snp_list_id", "counted_allele", "alt_allele"]
    af = genotype.groupBy(*keys).agg((F.avg("dosage") / 2).alias("original_alt_af"))
    flip = F.coalesce(F.col("original_alt_af") > 0.5, F.lit(False))
    out = genotype.join(af, keys)
    return out.withColumns(
        {
            "dosage": F.when(flip, 2 - F.col("dosage")).otherwise(F.col("dosage")),
            "counted_allele": F.when(flip, F.col("alt_allele")).otherwise(F.col("counted_allele")),
            "alt_allele": F.when(flip, F.col("counted_allele")).otherwise(F.col("alt_allele")),
            "maf_corrected": flip,
        }
    )


def corrected(genotype: DataFrame, plan: DataFrame) -> DataFrame:
    """``maf_correction(harmonize_dosage(genotype, plan))`` with genotypes dealt once, by variant, or not at all where their variants lie together already.

    Frequencies come from the raw calls, before a variant has a row for each of its list rows: every action turns the dosage around, so the frequency after it is one less that of the raw calls.
    The calls of a variant lie together for the join with its list rows anyway, so their mean is taken there, by file; a window of many samples spills. Calls that no list row matches go before it.
    """
    plan = plan.select("variant_id", "snp_list_id", "chromosome", "position", "action", "list_ref", "list_alt", "ref", "alt")
    sources = [c for c in ("data_type", "source") if c in genotype.columns]
    file = Window.partitionBy("variant_id", *sources)
    # a task holds its share of the plan, a small part of the list, and the calls stream by
    plan = plan.hint("shuffle_hash")
    raw = genotype.join(plan.select("variant_id").hint("shuffle_hash"), "variant_id", "left_semi").withColumn("__raw", F.avg("dosage").over(file) / 2)
    known = F.coalesce(F.col("action").isin("EXACT", "SWAP", "FLIP", "FLIP_SWAP"), F.lit(False))
    rows = raw.join(plan, "variant_id").withColumn("original_alt_af", F.when(known, 1 - F.col("__raw")).otherwise(F.col("__raw")))
    flip = F.coalesce(F.col("original_alt_af") > 0.5, F.lit(False))
    counted, other = F.when(known, F.col("list_alt")).otherwise(F.col("ref")), F.when(known, F.col("list_ref")).otherwise(F.col("alt"))
    dosage = F.when(known != flip, 2 - F.col("dosage")).otherwise(F.col("dosage"))
    return rows.select(
        *(dosage.alias(c) if c == "dosage" else F.col(c) for c in genotype.columns), "snp_list_id", "chromosome", "position", "action", F.when(flip, other).otherwise(counted).alias("counted_allele"),
        F.when(flip, counted).otherwise(other).alias("alt_allele"), "original_alt_af", flip.alias("maf_corrected"),
    )


def merge_sources(genotype: DataFrame, order: str, keys: list[str] | None = None, *metadata: str, dealt: bool = False) -> DataFrame:
    """One row per key and sample: the first non-null dosage, and the first non-null value of each ``metadata`` column, by ``order``.

    ``dealt``: the genotypes are read from a table in buckets of one of the keys, so they stay where they are.
    """
    keys = [*(keys or KEYS)]
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c)
    # rows of a variant lie together where they are stored and are dealt together, so what they share is packed well
    return (genotype if dealt else genotype.repartition(*keys)).groupBy(*keys, "sample_id").agg(first("dosage"), *map(first, metadata))


def first_per_key(df: DataFrame, keys: list[str], *order: str | Column) -> DataFrame:
    """The first row of each key by a total order."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__n = 1").drop("__n")


def unique_positions(sites: DataFrame) -> DataFrame:
    """Sites whose position occurs once; all rows of a repeated position go."""
    again = sites.groupBy("chromosome", "position").agg(F.count(F.lit(1)).alias("__n")).where("__n = 1").drop("__n")
    return sites.join(again, ["chromosome", "position"], "left_semi")


def update_alleles(pvar: DataFrame, matches: DataFrame) -> DataFrame:
    """Sites with flipped strands turned to the list's, and the allele that counts set for swapped ones."""
    a = matches.select("variant_id", "action").distinct()
    flip = F.coalesce(F.col("action").isin("FLIP", "FLIP_SWAP"), F.lit(False))
    swap = F.coalesce(F.col("action").isin("SWAP", "FLIP_SWAP"), F.lit(False))
    out = pvar.join(a, "variant_id", "left").withColumns({"ref": F.when(flip, s.complement("ref")).otherwise(F.col("ref")), "alt": F.when(flip, s.complement("alt")).otherwise(F.col("alt"))})
    return out.withColumn("a1", F.when(swap, F.col("ref")).otherwise(F.col("alt")))


def genotype_strings(genotype: DataFrame, variants: DataFrame) -> DataFrame:
    """Legacy genotype text of each call (the dosage counts reference alleles)."""
    return genotype.join(variants.select("variant_id", "alt"), "variant_id").withColumn("genotype", s.genotype_string("dosage", "alt"))


def verify_strings(strings: DataFrame) -> DataFrame:
    """Whether text and dosage of a call agree."""
    d, g = F.col("dosage").cast("int"), F.col("genotype")
    ok = F.when(d.isNull(), g == "./.").when(d == 2, g == "WT/WT").when(d == 1, g.startswith("WT/") & (g != "WT/WT")).when(d == 0, g == F.concat_ws("/", "alt", "alt")).otherwise(g == ":/:")
    return strings.withColumn("ok", ok)
