"""Many VCF files, plain or gz, of one sample or of many, read at once.

Header rows are kept by file and joined to the records of their file; sample columns become rows by their position. What is wrong with a file is a row, not an error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusweave.operators import vcf
from locusweave.sources import matrix

HEADER = "#CHROM\t"
#: Columns of a record before its samples.
N_FIXED = 9


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with the path of their file, and the sample id that its name holds."""
    name = F.regexp_replace(F.col("_metadata.file_name"), r"(\.snv)?\.vcf(\.gz)?$", "")
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), name.alias("IID"))


def header_rows(lines: DataFrame) -> DataFrame:
    """file, IID and the samples of each header line."""
    parts = F.split(F.regexp_replace("value", r"\r$", ""), "\t")
    return lines.where(F.startswith("value", F.lit(HEADER))).select("file", "IID", F.slice(parts, N_FIXED + 1, F.greatest(F.size(parts) - N_FIXED, F.lit(0))).alias("samples"))


def file_states(lines: DataFrame) -> DataFrame:
    """file, IID, n_samples, n_records and state of each file: ``ok``, ``no header``, ``several headers`` or ``not one sample``; all from one pass, with partial sums by task."""
    head = F.startswith("value", F.lit(HEADER))
    record = ~F.startswith("value", F.lit("#")) & (F.trim("value") != "")
    n_samples = F.size(F.split("value", "\t")) - N_FIXED
    found = lines.groupBy("file", "IID").agg(F.count_if(head).alias("__heads"), F.max(F.when(head, n_samples)).alias("n_samples"), F.count_if(record).alias("n_records"))
    state = F.when(F.col("__heads") == 0, "no header").when(F.col("__heads") > 1, "several headers").when(F.col("n_samples") != 1, "not one sample").otherwise("ok")
    return found.select("file", "IID", F.greatest(F.coalesce("n_samples", F.lit(0)), F.lit(0)).alias("n_samples"), "n_records", state.alias("state"))


def one_sample_lines(lines: DataFrame) -> DataFrame:
    """Lines of the files that hold exactly one sample."""
    return lines.join(file_states(lines).where("state = 'ok'").select("file"), "file", "left_semi")


def sample_metrics(lines: DataFrame) -> DataFrame:
    """The metrics of all files of one sample, with the sample's id from the file's name."""
    return vcf.sample_metrics(one_sample_lines(lines), "IID")


def calls(lines: DataFrame, skip: str | None = None) -> DataFrame:
    """chromosome, position, variant_id, ref, alt, format, sample_id, sample (its field) and file of each call: sample columns by their position against the header of their file.

    Fields beyond the header have no sample and are left out, as are files without a header, and fields that are ``skip`` before they become rows.
    """
    samples = header_rows(lines).dropDuplicates(["file"]).select(F.col("file").alias("__of"), F.posexplode("samples").alias("__at", "sample_id"))
    records = lines.where(~F.startswith("value", F.lit("#")) & (F.trim("value") != "")).select("file", "value")
    cells = matrix.cells_of(records, vcf.FIXED[:N_FIXED], skip).withColumnRenamed("cell", "sample")
    rows = cells.join(samples, (F.col("file") == F.col("__of")) & (F.col("at") - N_FIXED == F.col("__at")))
    return vcf.normalized(rows).select("chromosome", "position", "variant_id", "ref", "alt", "format", "sample_id", "sample", "file")


def contents(lines: DataFrame, skip: str | None = None) -> DataFrame:
    """chromosome, position, ref, alt, sample_id and sample (its field) of each call, as ``calls`` finds them; a row more for each record, without sample_id and sample, and for each sample of a header, with its sample_id alone.

    ``lines`` as they are read. A packed file is read once, by one task, which sees its header first (``matrix.named_cells``); of plain files headers are read before.
    """
    fixed, nothing, packed = vcf.FIXED[:N_FIXED], F.lit(None).cast("string"), F.col("file").rlike(matrix.PACKED)
    # blank as a whole, found without going through a long line
    blank = (F.trim(F.substring_index("value", "\t", 1)) == "") & ~F.contains("value", F.lit("\t"))
    shown = F.startswith("value", F.lit(HEADER)) | (~F.startswith("value", F.lit("#")) & ~blank)
    columns = [*vcf.SITE, "sample_id", "sample"]
    found = vcf.normalized(matrix.named_cells(lines.where(packed & shown), HEADER, fixed, "sample_id", "sample", skip, whole=True)).select(*columns)
    plain = lines.where(~packed)
    rows = vcf.records(plain).select(*vcf.SITE, nothing.alias("sample_id"), nothing.alias("sample"))
    names = header_rows(plain).select(*(F.lit(None).cast("bigint" if c == "position" else "string").alias(c) for c in vcf.SITE), F.explode("samples").alias("sample_id"), nothing.alias("sample"))
    return found.unionByName(calls(plain, skip).select(*columns)).unionByName(rows).unionByName(names)


def samples_of(lines: DataFrame) -> DataFrame:
    """All samples that any header lists, each once."""
    return header_rows(lines).select(F.explode("samples").alias("sample_id")).distinct()
