"""Expression and protein tables as tools write them: one folder ``sample_id=NAME`` a sample, or a matrix of all samples.

Column names are those of the outside formats: fixed values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Names that outside formats give a column, the first that is there counts.
PROTEIN_COLUMNS = ("proteins", "protein", "protein_id", "protein_group")
PEPTIDE_COLUMNS = ("peptide", "stripped_peptide", "charge", "q_value", "score", "spectral_angle")
SAMPLE_COLUMNS = ("sampleid", "sample_id", "sample")
FEATURE_COLUMNS = ("olinkid", "assay", "uniprot", "seqid", "feature_id", "protein", "target")
VALUE_COLUMNS = ("npx", "rfu", "value", "quantity", "intensity")
#: Samples that are written to a folder each; a folder and its file cost tens of milliseconds on a local disk.
MAX_FOLDERS = 1000


def _table(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    return spark.read.csv(path, header=header, sep="\t", inferSchema=False)


def write_tables(rows: DataFrame, path: str, header: bool = True, folders: int = MAX_FOLDERS) -> None:
    """Tab-separated tables, one folder ``sample_id=NAME`` with one file a sample, for up to ``folders`` samples.

    Rows are dealt by sample first, so files grow with samples and not with samples times tasks;
    their number of tasks is given, as opening files takes longer than the rows. More samples
    share files, with the sample in the last column, where readers of folders find it too.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if rows.select("sample_id").distinct().limit(folders + 1).count() <= folders:
        rows.repartition(parts, "sample_id").write.partitionBy("sample_id").csv(path, header=header, sep="\t")
    else:
        rows.select(*[F.col(f"`{c}`") for c in rows.columns if c != "sample_id"], "sample_id").write.csv(path, header=header, sep="\t")


def _named(df: DataFrame, names: tuple[str, ...]) -> str | None:
    lower = {c.lower(): c for c in reversed(df.columns)}
    return next((lower[n] for n in names if n in lower), None)


def _number(name: str) -> Column:
    return F.col(f"`{name}`").try_cast("double")


def read_gene_table(spark: SparkSession, path: str) -> DataFrame:
    """(sample_id, gene, count) of tab-separated tables with a header: the first column is the gene, the second its count.

    Rows of one gene are added up; rows whose count is no number are left out. Values and ids
    are read as text, so every file may name its columns as it likes.
    """
    df = _table(spark, path)
    gene, count = [c for c in df.columns if c != "sample_id"][:2]
    rows = df.select(F.col("sample_id").cast("string").alias("sample_id"), F.col(f"`{gene}`").cast("string").alias("gene"), _number(count).alias("count"))
    return rows.where("gene is not null and count is not null").groupBy("sample_id", "gene").agg(F.sum("count").alias("count"))


def read_star_counts(spark: SparkSession, path: str, strand: int = 0) -> DataFrame:
    """(sample_id, gene, count) of per-gene read tables without a header: gene, unstranded, first and second strand.

    ``strand`` is 0, 1 or 2. The leading rows whose names begin with ``N_`` count reads of no gene and are left out.
    """
    rows = spark.read.schema("gene string, c0 string, c1 string, c2 string, sample_id string").csv(path, header=False, sep="\t")
    return rows.where("not startswith(gene, 'N_')").select("sample_id", "gene", _number(f"c{strand}").alias("count")).where("count is not null").groupBy("sample_id", "gene").agg(F.sum("count").alias("count"))


def read_abundance(spark: SparkSession, path: str) -> DataFrame:
    """(sample_id, tx, count, tpm) of transcript abundance tables with the columns target_id, est_counts and tpm."""
    df = _table(spark, path)
    rows = df.select(F.col("sample_id").cast("string").alias("sample_id"), F.col("target_id").alias("tx"), _number("est_counts").alias("count"), _number("tpm").alias("tpm"))
    return rows.where("tx is not null and count is not null and tpm is not null")


def genes_of_transcripts(abundance: DataFrame, tx2gene: DataFrame) -> DataFrame:
    """(sample_id, gene, count, tpm): sums over each gene's transcripts.

    A transcript's gene is that of its full id, else of its id without what follows the first
    dot, else the transcript itself. Of several genes for one id the least counts.
    """
    genes = tx2gene.where("tx is not null and gene is not null").groupBy("tx").agg(F.min("gene").alias("gene"))
    bare = F.substring_index("tx", ".", 1)
    j = abundance.withColumn("__bare", bare).join(genes.select("tx", F.col("gene").alias("__full")), "tx", "left").join(genes.select(F.col("tx").alias("__bare"), F.col("gene").alias("__short")), "__bare", "left")
    return j.groupBy("sample_id", F.coalesce("__full", "__short", "tx").alias("gene")).agg(F.sum("count").alias("count"), F.sum("tpm").alias("tpm"))


def read_peptide_table(spark: SparkSession, path: str) -> DataFrame:
    """(sample_id, protein, intensity): all intensities of a protein's peptides added up, those above 0.

    Every column that names no protein, peptide or score is an intensity; what is no number counts 0.
    """
    df = _table(spark, path)
    protein = _named(df, PROTEIN_COLUMNS)
    if protein is None:
        raise ValueError("no protein column")
    used = [c for c in df.columns if c not in (protein, "sample_id") and c.lower() not in PEPTIDE_COLUMNS]
    if not used:
        raise ValueError("no intensity column")
    total = sum((F.coalesce(_number(c), F.lit(0.0)) for c in used), F.lit(0.0))
    rows = df.select(F.col("sample_id").cast("string").alias("sample_id"), F.col(f"`{protein}`").alias("protein"), total.alias("v")).where("protein is not null")
    return rows.groupBy("sample_id", "protein").agg(F.sum("v").alias("intensity")).where("intensity > 0")


def read_panel_matrix(spark: SparkSession, path: str) -> DataFrame:
    """(sample_id, feature_id, value) of an assay's matrix, long or wide, all samples at once.

    Long if it has a column for the sample, one for the feature and one for the value; else the
    sample's column, or the first one, names the rows and every other column is a feature. What
    is no number is left out; of a feature given twice the last in the sort order of values counts.
    """
    df = _table(spark, path)
    sample, feature, value = (_named(df, n) for n in (SAMPLE_COLUMNS, FEATURE_COLUMNS, VALUE_COLUMNS))
    if sample and feature and value:
        rows = df.select(F.col(f"`{sample}`").alias("sample_id"), F.col(f"`{feature}`").alias("feature_id"), _number(value).alias("value"))
    else:
        key = sample or df.columns[0]
        cells = F.array(*[F.struct(F.lit(c).alias("feature_id"), _number(c).alias("value")) for c in df.columns if c != key])
        rows = df.select(F.col(f"`{key}`").alias("sample_id"), F.explode(cells).alias("c")).select("sample_id", "c.*")
    return rows.where("sample_id is not null and feature_id is not null and value is not null").groupBy("sample_id", "feature_id").agg(F.max("value").alias("value"))
