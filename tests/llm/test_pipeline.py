"""The five stages, and that everything registered is there."""

import random


import pytest

import __spark_entry__ as contract
import corpus_pipeline
from compare import connect, differences
from llm_documents import make, odd  # noqa: F401
from curbline.llm import queries

SQL = queries.ORACLES


@pytest.mark.parametrize("name", list(SQL))
def test_query_matches_sql(spark, sf_dir, name):
    assert differences(connect(sf_dir), queries.QUERIES[name](spark, sf_dir), SQL[name]) == ""


def test_registered():
    names = contract.queries().keys()
    assert {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{n}" for n in range(1, 11)}
    assert "pipeline" in names


def test_stages_over_their_whole_input(spark, make, odd, tmp_path):
    rng = random.Random(12)

    def words(n):
        return ["".join(rng.choices("aeioustnrlm", k=rng.randint(2, 7))) for _ in range(n)]

    clean = [(1000 + i, " ".join(words(60)), "de", f"s{i % 4}") for i in range(240)]
    toxic = []
    for i in range(120):
        own = words(60)
        for at in rng.sample(range(60), 5):
            own[at] = rng.choice(["rotzkerl", "dreckskerl", "mistvieh"])
        toxic.append((3000 + i, " ".join(own), "de", "s1"))
    copies = [(5000, clean[0][1], "de", "s2"), (5001, clean[1][1].rsplit(" ", 1)[0] + " neu", "de", "s2")]
    marks = [(i, 1, 0) for i, *_ in clean] + [(i, 1, 1) for i, *_ in toxic]
    folder = str(tmp_path)
    spark.createDataFrame(marks, "doc_id BIGINT, quality INT, toxic INT").write.parquet(f"{folder}/labels.parquet")
    docs = make(clean + toxic + copies).unionByName(odd)
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name != "byte_bpe":
            assert out.columns == docs.columns
        out.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        kept[name] = {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert len({i for i, *_ in toxic} & kept["toxicity"]) <= 6
    assert len({i for i, *_ in clean} & kept["toxicity"]) >= 236
    assert {1000, 1001, 5000, 5001} <= kept["toxicity"]
    assert 5000 not in kept["exact_dedup"] and 5001 in kept["exact_dedup"]
    assert {i for i, *_ in clean} & kept["near_dup"] == {i for i, *_ in clean} & kept["toxicity"]
    assert 5001 not in kept["near_dup"]
    assert kept["mixing"] == kept["byte_bpe"] <= kept["near_dup"]
