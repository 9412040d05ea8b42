"""Queries without SQL over tables with rows beyond a prefix."""

from voxtrail.plans import registry


def test_clean_names_take_the_whole_text(spark, tmp_path):
    rows = [(1, "\n" * 70 + "Red Chair"), (2, "a " + "x" * 30 + " " + "y" * 30 + " " + "z" * 9 + " more")]
    rows.append((3, "." * 70 + " red chair"))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.name, r.bad) for r in registry.QUERIES["clean_names"](spark, str(tmp_path)).collect()}
    assert got[2] == ("x" * 30 + " " + "y" * 30 + " " + "z" * 9, False) and got[3] == ("red chair", False)


def test_box_corners_of_all_objects(spark, tmp_path):
    rows = [(i, 1, 7 * i, obj, 1.0, float(i)) for i, obj in enumerate((1, 10, 11, 500))]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = {r.obj: r for r in registry.QUERIES["box_corners"](spark, str(tmp_path)).collect()}
    assert set(got) == {1, 10, 11, 500}
    for i, obj in enumerate((1, 10, 11, 500)):
        assert abs((got[obj].lo_x + got[obj].hi_x) / 2 - i) < 2e-3
