"""The whole pipeline, and each stage's effect, against the plain version."""

import random

import brute
import public_tokenizers as pt
import pytest
import tiktoken

import corpus_pipeline
from perfkit.llm import byte_bpe
from perfkit.llm.common import table

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def prose(rng, n):
    return " ".join(rng.choice("abcdefghij") * rng.randint(1, 3) + rng.choice(["river", "stone", "Ran", "naïve", "day"])
                    + rng.choice(["", "", "s", ",", "."]) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(21)
    shared, leak = prose(rng, 70), prose(rng, 40)
    out = [(i, prose(rng, rng.randint(30, 200))) for i in range(25)]
    out += [(30, out[3][1]), (31, out[3][1].replace(" ", "\n", 5)), (32, out[3][1].upper()), (33, out[4][1] + " end")]
    out += [(40 + i, f"{prose(rng, 60)} {shared} {prose(rng, 60)}") for i in range(4)]
    out += [(50, f"{prose(rng, 30)} {leak.upper()} {prose(rng, 30)}"), (51, f"{leak}\n{prose(rng, 900)}")]
    out += [(60, None), (61, ""), (62, "too short"), (63, "line of words here\n" * 30), (64, "| a " * 40), (65, "1 2 3 " * 20),
            (66, "# # $ " + prose(rng, 25)), (67, "wow! so! " * 3 + "much! " + " ".join(f"w{i}!" for i in range(30)))]
    rng.shuffle(out)
    return out, [("i1", leak), ("i2", "never seen words " * 6), ("i3", None)]


@pytest.fixture(scope="module")
def folder(spark, rows, tmp_path_factory):
    path = tmp_path_factory.mktemp("corpus")
    docs, items = rows
    spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in docs], SCHEMA).repartition(3).write.parquet(
        f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id string, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_pipeline(spark, rows, folder):
    enc = tiktoken.Encoding("own", pat_str=pt.PATTERN, special_tokens={},
                            mergeable_ranks=byte_bpe.load_ranks(pt.path("byte_bpe_multi_50k.tiktoken")))
    got = [(r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"])
           for r in corpus_pipeline.run(spark, folder).collect()]
    assert sorted(got) == sorted(brute.pipeline(*rows, enc.encode_ordinary))


def test_stages_act_in_order(spark, rows, folder):
    docs, items = rows
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "simhash_dups", "substring_dedup", "decontaminate",
                                                      "byte_bpe"]
    here, left = table(spark, folder, "documents"), docs
    steps = [lambda r: [x for x in r if brute.kept_by_quality(x[1])],
             lambda r: [x for x, (_, _, c) in zip(r, brute.simhash_groups(r)) if c == x[0]],
             brute.without_shared,
             lambda r: [x for x, mark in zip(r, brute.contamination(r, items)) if not mark[-1]]]
    for (name, stage), step in zip(corpus_pipeline.STAGES, steps):
        columns = here.columns
        here = spark.createDataFrame(stage(spark, here, folder).collect(), SCHEMA)
        changed, left = left, step(left)
        assert here.columns == columns and changed != left, name
        assert sorted((r["doc_id"], r["text"]) for r in here.collect()) == sorted(left), name
        assert all(r["n_chars"] == len(r["text"]) for r in here.collect())
