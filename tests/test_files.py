from plumbline.plans import files as plans


def test_leaflets_are_a_file_per_key_in_few_folders(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(plans, "FILES_PER_TASK", 10)
    rows = [(i, f"S{i}", 1, 5.5) for i in range(40)] + [(3, "again", 1, 5.5), (None, "a", 1, 5.5), (None, "b", 1, 5.5)]
    supplier = spark.createDataFrame(rows, "s_suppkey long, s_name string, s_nationkey int, s_acctbal double").coalesce(1)
    supplier.write.parquet(str(tmp_path / "supplier.parquet"))
    found = plans.leaflets(spark, str(tmp_path)).collect()
    assert len(found) == 41 and len({r["path"].rpartition("/")[0] for r in found}) <= 5
    texts = [bytes(r["content"]).decode() for r in found]
    assert texts.count("\n\n") == 1  # rows without a key have no text, and are one file
    both = [t for t in texts if "supplier-3\"" in t]
    assert len(both) == 1 and both[0].count("supplier-3\"") == 2 and both[0].endswith("Nation 1 \n")
