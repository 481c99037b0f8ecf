"""Text formats read and written with Spark's own text and CSV sources. Names of columns, fields and lines are those of the outside formats: fixed values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_gtf(spark: SparkSession, path: str, feature: str = "exon") -> DataFrame:
    """Rows of one feature as 0-based half-open intervals with gene and transcript ids."""
    f = F.split("value", "\t")
    rows = spark.read.text(path).where(~F.col("value").startswith("#")).select(f.alias("f")).where((F.size("f") >= 9) & (F.col("f")[2] == feature))
    attr = lambda name: F.regexp_extract(F.col("f")[8], f'{name} "([^"]*)"', 1)
    return rows.select(F.col("f")[0].alias("chrom"), (F.col("f")[3].cast("long") - 1).alias("region_start"), F.col("f")[4].cast("long").alias("region_end"),
                       F.col("f")[6].alias("strand"), attr("gene_id").alias("gene_id"), attr("transcript_id").alias("transcript_id"))


def write_gtf(regions: DataFrame, path: str) -> None:
    """Intervals with gene ids as 1-based closed GTF lines."""
    line = F.concat_ws("\t", "chrom", F.lit("own"), "feature_type", (F.col("region_start") + 1).cast("string"), F.col("region_end").cast("string"), F.lit("."), "strand", F.lit("."),
                       F.concat(F.lit('gene_id "'), "gene_id", F.lit('"; transcript_id "'), "gene_id", F.lit('.1";')))
    regions.select(line.alias("value")).write.text(path)


def read_bed(spark: SparkSession, path: str) -> DataFrame:
    """First four columns of a BED file; header lines are skipped and a missing name is made from the place."""
    rows = spark.read.text(path).where(~F.col("value").rlike("^(#|track|browser)") & (F.trim("value") != "")).select(F.split("value", "\t").alias("f"))
    name = F.coalesce(F.get("f", F.lit(3)), F.concat(F.col("f")[0], F.lit(":"), F.col("f")[1], F.lit("-"), F.col("f")[2]))
    return rows.select(F.col("f")[0].alias("chrom"), F.col("f")[1].cast("long").alias("region_start"), F.col("f")[2].cast("long").alias("region_end"), name.alias("name"))


def write_bed(regions: DataFrame, path: str) -> None:
    regions.repartitionByRange("chrom", "region_start").sortWithinPartitions("chrom", "region_start").select(
        F.concat_ws("\t", "chrom", F.col("region_start").cast("string"), F.col("region_end").cast("string"), "name").alias("value")).write.text(path)


def read_gmt(spark: SparkSession, path: str) -> DataFrame:
    """(term, description, gene) from lines of a term, a description and its genes."""
    f = spark.read.text(path).select(F.split("value", "\t").alias("f")).where(F.size("f") > 2)
    return f.select(F.col("f")[0].alias("term"), F.col("f")[1].alias("description"), F.explode(F.filter(F.slice("f", F.lit(3), F.size("f")), lambda g: g != "")).alias("gene"))


def write_gmt(sets: DataFrame, path: str) -> None:
    g = sets.groupBy("term", "description").agg(F.array_sort(F.collect_set("gene")).alias("g"))
    g.select(F.concat_ws("\t", "term", "description", F.array_join("g", "\t")).alias("value")).write.text(path)


def first_of(df: DataFrame, names: list[str], kind: str) -> Column:
    """The first of several candidate columns that the table has, else null."""
    found = [F.col(f"`{n}`").cast(kind) for n in names if n in df.columns]
    return F.coalesce(*found) if found else F.lit(None).cast(kind)


def read_sites_csv(spark: SparkSession, path: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """A table of tested sites with the usual column names; effect size is repaired from delta and overlap. Integer columns in ``keep`` stay."""
    df = spark.read.csv(path, header=True)
    delta, overlap = first_of(df, ["delta_mean", "delta", "mean_diff"], "double"), first_of(df, ["overlap", "bhattacharyya"], "double")
    return df.select(
        *[F.col(c).cast("int").alias(c) for c in keep], first_of(df, ["chrom", "chromosome", "chr"], "string").alias("chrom"), first_of(df, ["pos", "position", "start"], "long").alias("pos"),
        first_of(df, ["p_value", "pvalue", "p"], "double").alias("p_value"), delta.alias("delta_mean"),
        F.coalesce(first_of(df, ["effect_size", "effect"], "double"), F.abs(delta) * (1 - F.coalesce(overlap, F.lit(0.0)))).alias("effect_size"))


def parse_locus(name: Column) -> tuple[Column, Column, Column]:
    """chrom, pos and context of a ``chrom:pos:context:...`` name; null where it has another form."""
    f = F.split(name, ":")
    pos = F.get(f, F.lit(1)).try_cast("long")
    ok = pos.isNotNull()
    return F.when(ok, F.get(f, F.lit(0))), pos, F.when(ok, F.get(f, F.lit(2)))


def flatten_json(df: DataFrame, key: str, json_col: str) -> DataFrame:
    """(key, metric, value) of a flat JSON object per row; values that are no numbers are left out."""
    m = F.from_json(json_col, "map<string,string>")
    return df.select(key, F.explode(m).alias("metric", "text")).select(key, "metric", F.col("text").try_cast("double").alias("value")).where("value is not null")


def read_protein_report(spark: SparkSession, path: str) -> DataFrame:
    """(run, protein, intensity): largest intensity of each protein group and run in a tab-separated report."""
    df = spark.read.csv(path, header=True, sep="\t")
    rows = df.select(first_of(df, ["Run", "File.Name"], "string").alias("run"), first_of(df, ["Protein.Group", "Protein.Ids", "Protein.Names"], "string").alias("protein"),
                     first_of(df, ["PG.MaxLFQ", "PG.Quantity", "Precursor.Quantity"], "double").alias("q")).where("protein is not null and q is not null")
    return rows.groupBy("run", "protein").agg(F.max("q").alias("intensity"))


def read_flagstat(spark: SparkSession, path: str) -> DataFrame:
    """(sample_id, total, mapped, mapped_rate) from flagstat texts in a folder per sample; a sample's lines may be in several files."""
    rows = spark.read.schema("value string, sample_id string").text(path)
    n = F.regexp_extract("value", r"^(\d+) \+", 1).try_cast("long")
    g = rows.groupBy("sample_id").agg(F.sum(F.when(F.col("value").contains(" in total "), n)).alias("total"), F.sum(F.when(F.col("value").rlike(r"^\d+ \+ \d+ mapped \("), n)).alias("mapped"))
    return g.withColumn("mapped_rate", F.when(F.col("total") > 0, F.col("mapped") / F.col("total")))
