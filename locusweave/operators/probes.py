"""Array probes against sequencing: metrics, ranking, choice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusweave.functions import sites as s


def probe_grid(genotype: DataFrame, least_probes: int = 1) -> DataFrame:
    """Each NBA probe with the first WGS variant of its list row, over all samples that both sources have; missing calls count as 0.

    ``genotype`` holds the rows of both sources (data_type NBA and WGS); it is read three times, so a stored table is best. Only calls that aren't 0 in either
    source are gathered, for list rows with ``least_probes`` probes or more; samples with none are counted by difference in the metrics. A probe without any has a row without a sample.
    All rows of a list row lie together, from the join with its probes to the ranking of these.
    """
    rows = genotype.where(F.col("data_type").isin("NBA", "WGS")).withColumn("array", F.col("data_type") == "NBA")
    shared = rows.groupBy("sample_id").agg(F.bool_or("array").alias("a"), F.bool_or(~F.col("array")).alias("b")).where("a AND b").select("sample_id")
    named = rows.select("snp_list_id", "array", "variant_id").distinct()
    # a list row has a handful of probes
    plan = named.groupBy("snp_list_id").agg(F.collect_set(F.when(F.col("array"), F.col("variant_id"))).alias("probes"), F.min(F.when(~F.col("array"), F.col("variant_id"))).alias("truth"))
    plan = plan.withColumn("n_probes", F.size("probes").cast("long")).where((F.col("n_probes") >= least_probes) & (F.col("n_probes") > 0) & F.col("truth").isNotNull())
    pairs = plan.select("snp_list_id", F.explode("probes").alias("variant_id"), "truth", "n_probes")
    # dealt twice, by sample and by list row: source and dosage go as one number, made before the join with the shared samples, of which each is there once
    d = F.coalesce("dosage", F.lit(0.0)).cast("int")
    called = rows.where(d != 0).select(F.col("snp_list_id").alias("__row"), F.col("variant_id").alias("__of"), "sample_id", (d.cast("long") * 2 + F.col("array").cast("int")).alias("__call"))
    calls = called.join(shared, "sample_id")
    array, d = F.col("__call").bitwiseAND(1) == 1, F.shiftright("__call", 1).cast("int")
    found = pairs.join(calls, (F.col("snp_list_id") == F.col("__row")) & (F.when(array, F.col("variant_id")).otherwise(F.col("truth")) == F.col("__of")), "left")
    nba, wgs = F.when(array, d).when(~array, 0), F.when(array, 0).when(~array, d)
    grid = found.groupBy("snp_list_id", "variant_id", "n_probes", "sample_id").agg(F.max(nba).alias("nba"), F.max(wgs).alias("wgs"))
    n = shared.agg(F.count(F.lit(1))).scalar()
    return grid.select("snp_list_id", "variant_id", "n_probes", "sample_id", "nba", "wgs", n.alias("shared"))


def probe_metrics(grid: DataFrame) -> DataFrame:
    """Diagnostic and concordance metrics of each probe. Shared samples without a call in either source are 0 / 0."""
    pair = {(i, j): s.count_if((F.col("nba") == i) & (F.col("wgs") == j)) for i in range(3) for j in range(3)}
    counts = grid.groupBy("snp_list_id", "variant_id", "n_probes").agg(F.first("shared").alias("samples"), F.count("sample_id").alias("called"), *(c.alias(f"nba_{i}_wgs_{j}") for (i, j), c in pair.items()))
    counts = counts.withColumn("nba_0_wgs_0", F.col("nba_0_wgs_0") + F.col("samples") - F.col("called")).drop("called")
    at = lambda i, j: F.col(f"nba_{i}_wgs_{j}")
    tp = at(1, 1) + at(1, 2) + at(2, 1) + at(2, 2)
    fp, fn, tn = at(1, 0) + at(2, 0), at(0, 1) + at(0, 2), at(0, 0)
    out = counts.withColumns({"tp": tp, "fp": fp, "fn": fn, "tn": tn})
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    same = at(0, 0) + at(1, 1) + at(2, 2)
    column = lambda j: at(0, j) + at(1, j) + at(2, j)
    out = out.withColumns(
        {
            "sensitivity": s.ratio(tp, tp + fn),
            "specificity": s.ratio(tn, tn + fp),
            "ppv": s.ratio(tp, tp + fp),
            "npv": s.ratio(tn, tn + fn),
            "overall_concordance": s.ratio(same, F.col("samples")),
            "wt_concordance": s.ratio(at(0, 0), column(0)),
            "het_concordance": s.ratio(at(1, 1), column(1)),
            "hom_concordance": s.ratio(at(2, 2), column(2)),
            "misclassified": at(1, 2) + at(2, 1),
        }
    )
    return out.withColumn("quality", 0.7 * F.col("overall_concordance") + 0.3 * F.col("sensitivity")).withColumn("probe_type", s.probe_type("variant_id"))


def _graded(*steps: tuple[Column, float], rest: float = 0.6) -> Column:
    out = None
    for test, value in steps:
        out = F.when(test, value) if out is None else out.when(test, value)
    return out.otherwise(rest)


def ranked(metrics: DataFrame) -> DataFrame:
    """By list row, in one aggregate, the best probe of each ranking with its metrics: by sensitivity, then specificity (``d``); by overall concordance, then
    sensitivity (``c``); then by id."""
    probe = F.struct("variant_id", "sensitivity", "specificity", "overall_concordance")
    first = lambda *by: F.min_by(probe, F.struct(*((-F.col(c)).alias(c) for c in by), "variant_id"))
    return metrics.groupBy("snp_list_id").agg(first("sensitivity", "specificity").alias("d"), first("overall_concordance", "sensitivity").alias("c"), F.max("n_probes").alias("n_probes"))


def _diagnostic(sensitivity: float = 0.8, specificity: float = 0.95) -> list[Column]:
    good = F.col("d.sensitivity") >= sensitivity
    confidence = _graded((good & (F.col("d.specificity") >= specificity), 0.95), (good, 0.8))
    text = F.format_string("sensitivity %.3f, specificity %.3f", "d.sensitivity", "d.specificity")
    return [F.col("d.variant_id").alias("diagnostic_choice"), confidence.alias("diagnostic_confidence"), text.alias("diagnostic_rationale")]


def _concordance(high: float = 0.9, fair: float = 0.85) -> list[Column]:
    confidence = _graded((F.col("c.overall_concordance") >= high, 0.95), (F.col("c.overall_concordance") >= fair, 0.8))
    text = F.format_string("concordance %.3f, carrier sensitivity %.3f", "c.overall_concordance", "c.sensitivity")
    return [F.col("c.variant_id").alias("concordance_choice"), confidence.alias("concordance_confidence"), text.alias("concordance_rationale")]


def rank_diagnostic(metrics: DataFrame, sensitivity: float = 0.8, specificity: float = 0.95) -> DataFrame:
    """Best probe by sensitivity, then specificity, then id, with a confidence."""
    return ranked(metrics).select("snp_list_id", *_diagnostic(sensitivity, specificity), "n_probes")


def rank_concordance(metrics: DataFrame, high: float = 0.9, fair: float = 0.85) -> DataFrame:
    """Best probe by overall concordance, then carrier sensitivity, then id, with a confidence."""
    return ranked(metrics).select("snp_list_id", *_concordance(high, fair))


def consensus(metrics: DataFrame) -> DataFrame:
    """Where both rankings agree, that probe with their mean confidence; else none. List rows with one probe aren't ranked.

    ``d`` and ``c`` keep the metrics of both choices.
    """
    both = ranked(metrics.where("n_probes > 1")).select("snp_list_id", *_diagnostic(), "n_probes", *_concordance(), "d", "c")
    agree = F.col("diagnostic_choice") == F.col("concordance_choice")
    return both.withColumns(
        {
            "agree": agree,
            "recommended_probe": F.when(agree, F.col("diagnostic_choice")),
            "confidence": F.when(agree, (F.col("diagnostic_confidence") + F.col("concordance_confidence")) / 2),
        }
    )


#: Why the rankings differ.
REASONS = {
    "sensitivity": "Diagnostic prioritized sensitivity, concordance prioritized overall accuracy",
    "specificity": "Diagnostic prioritized specificity, concordance prioritized overall accuracy",
    "similar": "Methods chose different probes with similar performance metrics",
    "mixed": "Complex trade-off between sensitivity, specificity, and concordance",
}


def disagreement_reason(choices: DataFrame) -> DataFrame:
    """Why the rankings differ."""
    ds, cs, dp, cp, dc, cc = (F.col(f"{p}.{m}") for m in ("sensitivity", "specificity", "overall_concordance") for p in "dc")
    reason = (
        F.when((ds > cs) & (dc < cc), REASONS["sensitivity"])
        .when((dp > cp) & (dc < cc), REASONS["specificity"])
        .when((F.abs(ds - cs) < 0.05) & (F.abs(dc - cc) < 0.05), REASONS["similar"])
        .otherwise(REASONS["mixed"])
    )
    return choices.where("NOT agree").select("snp_list_id", "diagnostic_choice", "concordance_choice", reason.alias("reason"))


def selection_map(choices: DataFrame) -> DataFrame:
    """The probe to use for each list row with several: consensus, else the diagnostic choice."""
    return choices.select("snp_list_id", F.coalesce("recommended_probe", "diagnostic_choice").alias("selected_probe"), (F.col("n_probes") - 1).alias("excluded"))


def probe_filter(rows: DataFrame, selected: DataFrame, data_type: str | None = None) -> DataFrame:
    """Keep rows of single probes, and of several probes the selected one; all of them where none is selected. With ``data_type`` rows of other types stay.

    What stays is found for list rows and probes, without their calls, and joined by variant: rows that are dealt so stay where they are. A variant has a handful of list rows.
    """
    named = (rows if data_type is None else rows.where(F.col("data_type") == data_type)).select("snp_list_id", "variant_id").distinct()
    probes = named.groupBy("snp_list_id").agg(F.collect_list("variant_id").alias("probes"))
    chosen = selected.select("snp_list_id", F.col("selected_probe").alias("__p"))
    kept = probes.join(chosen, "snp_list_id", "left").select("snp_list_id", "__p", F.size("probes").alias("__n"), F.explode("probes").alias("variant_id"))
    kept = kept.where((F.col("__n") == 1) | F.isnull("__p") | (F.col("__p") == F.col("variant_id")))
    of = kept.groupBy("variant_id").agg(F.collect_set("snp_list_id").alias("__rows"))
    found = F.coalesce(F.array_contains("__rows", F.col("snp_list_id")), F.lit(False))
    return rows.join(of, "variant_id", "left").where(found if data_type is None else found | (F.col("data_type") != data_type)).select(*rows.columns)


def probe_summary(metrics: DataFrame) -> DataFrame:
    return metrics.agg(
        F.countDistinct("snp_list_id").alias("mutations"), F.countDistinct(F.when(F.col("n_probes") > 1, F.col("snp_list_id"))).alias("multi_probe_mutations"),
        F.count(F.lit(1)).alias("comparisons"), F.max("samples").alias("shared_samples"),
    )


def method_agreement(choices: DataFrame) -> DataFrame:
    yes = s.count_if(F.col("agree"))
    n = F.count(F.lit(1))
    return choices.agg(yes.alias("agreements"), (n - yes).alias("disagreements"), s.ratio(yes, n).alias("agreement_rate"))
