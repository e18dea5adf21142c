"""Which list variants a source's sites cover."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusweave.functions import sites as s


def variant_keys(snp_list: DataFrame) -> DataFrame:
    """variant_id chr:pos:ref:alt and pos_key chr:pos, for rows that have hg38 coordinates."""
    part = F.split("hg38", ":")
    chrom = s.prefixed_chromosome(F.get(part, F.lit(0)))
    return snp_list.where("hg38 IS NOT NULL").withColumns({"variant_key": F.concat_ws(":", chrom, F.get(part, F.lit(1)), F.get(part, F.lit(2)), F.get(part, F.lit(3))), "pos_key": F.concat_ws(":", chrom, F.get(part, F.lit(1)))})


def site_keys(pvar: DataFrame) -> DataFrame:
    chrom = s.prefixed_chromosome("chromosome")
    return pvar.select(F.concat_ws(":", chrom, F.col("position").cast("string"), "ref", "alt").alias("variant_key"), F.concat_ws(":", chrom, F.col("position").cast("string")).alias("pos_key"))


def coverage_by_variant(snp_list: DataFrame, sources: dict[str, DataFrame]) -> DataFrame:
    """Flags ``{source}_exact`` and ``{source}_position`` for each list row."""
    out = variant_keys(snp_list)
    for name, pvar in sources.items():
        keys = site_keys(pvar)
        exact = keys.select("variant_key").distinct().withColumn("__e", F.lit(True))
        place = keys.select("pos_key").distinct().withColumn("__p", F.lit(True))
        out = out.join(exact, "variant_key", "left").join(place, "pos_key", "left")
        out = out.withColumns({f"{name}_exact": F.coalesce("__e", F.lit(False)), f"{name}_position": F.coalesce("__p", F.lit(False))}).drop("__e", "__p")
    return out


def coverage_by_source(snp_list: DataFrame, sites: DataFrame, *by: str) -> DataFrame:
    """List variants that each source covers, exactly and by position, by gene; ``by`` names what a source is (data type, ancestry).

    One join for any number of sources. ``sites``: the ``by`` columns, chromosome, position, ref, alt.
    """
    listed = variant_keys(snp_list).select("gene", "variant_key", "pos_key")
    chrom = s.prefixed_chromosome("chromosome")
    keys = sites.select(*by, F.concat_ws(":", chrom, F.col("position").cast("string")).alias("pos_key"), F.concat_ws(":", chrom, F.col("position").cast("string"), "ref", "alt").alias("site"))
    hits = listed.join(keys, "pos_key").groupBy(*by, "gene", "variant_key").agg(F.bool_or(F.col("site") == F.col("variant_key")).alias("exact"))
    counted = hits.groupBy(*by, "gene").agg(s.count_if(F.col("exact")).alias("exact"), F.count(F.lit(1)).alias("position"))
    total = listed.groupBy("gene").agg(F.countDistinct("variant_key").alias("total_variants"))
    pct = lambda c: F.round(100 * s.ratio(F.col(c), F.col("total_variants")), 6).alias(f"{c}_pct")
    return counted.join(total, "gene").select(*by, "gene", "total_variants", "exact", pct("exact"), "position", pct("position"))


def coverage_by_locus(flags: DataFrame, sources: list[str]) -> DataFrame:
    n = F.countDistinct("variant_key")
    out = [n.alias("total_variants")]
    for name in sources:
        for kind in ("exact", "position"):
            hit = F.countDistinct(F.when(F.col(f"{name}_{kind}"), F.col("variant_key")))
            out += [hit.alias(f"{name}_{kind}"), F.round(100 * s.ratio(hit, n), 6).alias(f"{name}_{kind}_pct")]
    return flags.groupBy("gene").agg(*out)


def coverage_summary(by_locus: DataFrame, sources: list[str]) -> DataFrame:
    """Totals over genes; a variant of two genes counts twice."""
    n = F.sum("total_variants")
    out = [n.alias("total_variants")]
    for name in sources:
        for kind in ("exact", "position"):
            hit = F.sum(f"{name}_{kind}")
            out += [hit.alias(f"{name}_{kind}"), F.round(100 * s.ratio(hit, n), 6).alias(f"{name}_{kind}_pct")]
    return by_locus.agg(*out)


def list_minus_list(first: DataFrame, second: DataFrame, key: str = "hg38") -> DataFrame:
    """The second list, and what of the first it lacks."""
    return first.join(second.select(key), key, "left_anti").unionByName(second)


def curate(names: DataFrame) -> DataFrame:
    """From ``locus (name)`` texts and coordinates, one row per coordinate with an alternative name; names of several coordinates go.

    ``names``: label, hg38, rank (file order).
    """
    parts = names.select(
        F.when(F.regexp_extract("label", r"^(\S+) \((.*)\)$", 1) == "GBA", "GBA1").otherwise(F.regexp_extract("label", r"^(\S+) \((.*)\)$", 1)).alias("locus"),
        F.regexp_extract("label", r"^(\S+) \((.*)\)$", 2).alias("name"), "hg38", "rank",
    )
    several = parts.groupBy("name").agg(F.countDistinct("hg38").alias("n")).where("n > 1").select("name")
    kept = parts.join(several, "name", "left_anti")
    firsts = kept.groupBy("hg38", "locus", "name").agg(F.min("rank").alias("rank"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("rank", "name", "locus"))), lambda x: F.struct(x["name"].alias("name"), x["locus"].alias("locus")))
    out = firsts.groupBy("hg38").agg(ordered.alias("all"))
    others = F.array_except(F.array_distinct(F.transform("all", lambda x: x["name"])), F.array(F.get("all", F.lit(0))["name"]))
    return out.select("hg38", F.get("all", F.lit(0))["locus"].alias("locus"), F.get("all", F.lit(0))["name"].alias("name"), F.get(others, F.lit(0)).alias("alternative_name"))


def identical_columns(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Common columns of two tables, and whether they hold equal values in all rows of the full join on the keys."""
    common = [c for c in left.columns if c in right.columns and c not in keys]
    a = left.select(*keys, *(F.col(c).alias(f"__a_{c}") for c in common))
    b = right.select(*keys, *(F.col(c).alias(f"__b_{c}") for c in common))
    both = a.join(b, keys, "full")
    one = both.agg(*(F.bool_and(F.col(f"__a_{c}").eqNullSafe(F.col(f"__b_{c}"))).alias(c) for c in common))
    return one.unpivot([], common, "column_name", "identical")
