"""Tables of samples as files: their number, and both layouts read alike."""

import pytest

from sitewise.sources import expression


@pytest.mark.parametrize("folders", [1000, 2])
def test_layouts_of_sample_tables(spark, tmp_path, folders):
    rows = spark.createDataFrame([(str(s), f"G{g}", float(g), float(g * s)) for s in range(1, 4) for g in range(4) for _ in range(8)], "sample_id string, gene string, a double, b double").repartition(8)
    for name, header in (("genes", True), ("star", False)):
        table = rows if header else rows.selectExpr("sample_id", "gene", "a", "b", "a as c")
        expression.write_tables(table, f"{tmp_path}/{name}", header, folders)
    expression.write_tables(rows.selectExpr("sample_id", "gene as protein", "a as `x.mzML`", "b as `y.mzML`"), f"{tmp_path}/peptides", True, folders)
    files = list((tmp_path / "genes").rglob("*.csv"))
    assert len(files) == 3 if folders > 2 else len(files) <= 8 and not list((tmp_path / "genes").glob("sample_id=*"))
    got = {(r.sample_id, r.gene): r["count"] for r in expression.read_gene_table(spark, f"{tmp_path}/genes").collect()}
    assert got == {(str(s), f"G{g}"): 8.0 * g for s in range(1, 4) for g in range(4)}
    got = {(r.sample_id, r.gene): r["count"] for r in expression.read_star_counts(spark, f"{tmp_path}/star", 1).collect()}
    assert got == {(str(s), f"G{g}"): 8.0 * g * s for s in range(1, 4) for g in range(4)}
    got = {(r.sample_id, r.protein): r.intensity for r in expression.read_peptide_table(spark, f"{tmp_path}/peptides").collect()}
    assert got == {(str(s), f"G{g}"): 8.0 * g * (1 + s) for s in range(1, 4) for g in range(1, 4)}
