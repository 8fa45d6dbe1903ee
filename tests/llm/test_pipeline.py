"""The pipeline: every stage against what it must do, and the order of the whole."""

from __future__ import annotations

import corpus_pipeline
from scriptorium.llm import packing, queries


def test_stages(spark, docs, tmp_path):
    rows = docs.collect()
    labels = [(r["doc_id"], int(r["doc_id"] % 6 == 0)) for r in rows]
    bad = [(r["doc_id"], r["text"] + " vilewords nastiest" if y else r["text"], r["lang"], r["source"], r["n_chars"]) for r, (_, y) in zip(rows, labels)]
    passage = " ".join(f"only{k} here{k}" for k in range(20))
    bad.append((900, "Before it. " + passage + " after it", "en", "s", 1))
    folder = str(tmp_path)
    spark.createDataFrame(bad, docs.schema).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    df = spark.read.parquet(f"{folder}/documents.parquet")
    left = []
    for name, stage in corpus_pipeline.STAGES:
        columns = df.columns
        df = stage(spark, df, folder)
        if name != "best_fit_packing":
            assert df.columns == columns
            path = f"{folder}/{name}"
            df.write.parquet(path)
            df = spark.read.parquet(path)
            left.append({r["doc_id"] for r in df.collect()})
    assert left[0] == {r[0] for r in bad} - {d for d, y in labels if y}
    assert left[1] == left[0] and left[2] < left[1] and left[2] - left[3] == {900}
    whole = {(r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in corpus_pipeline.run(spark, folder).collect()}
    assert whole == {(r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in df.collect()}
    assert {d for d, *_ in whole} == left[3]
    assert packing.tokenise(spark.read.parquet(f"{folder}/benchmark_decontamination")).count() == len(whole)


def test_one_query_for_each_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 11)) and set(queries.ORACLES) <= set(queries.QUERIES)
