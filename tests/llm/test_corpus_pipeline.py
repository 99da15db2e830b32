"""The pipeline on a small corpus with planted cases, and stage by stage against brute force."""

from __future__ import annotations

import random

import pytest

import corpus_pipeline as P
from galegrid.llm.queries import QUERIES

from .test_mixing import targets
from .test_ngram_join import brute as components_of

BAD = ("grubble", "snarfle", "vexous", "mordle")


def text(rng, n):
    return " ".join(
        " ".join(f"{rng.choice('abcdefghij')}{rng.randrange(4000)}" for _ in range(rng.randint(4, 9))) + rng.choice(".,")
        for _ in range(n)
    )


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(11)
    docs = {i: text(rng, rng.randint(8, 30)) for i in range(400)}
    toxic = {i for i in docs if rng.random() < 0.2}
    for i in toxic:
        words = docs[i].split()
        for _ in range(4):
            words.insert(rng.randrange(len(words)), rng.choice(BAD))
        docs[i] = " ".join(words)
    clean = [i for i in docs if i not in toxic]
    items = {k: " ".join(text(rng, 6).split()[:30]) for k in range(6)}
    leaks = set(rng.sample(clean, 8))
    for n, i in enumerate(sorted(leaks)):
        part = items[n % 6].split()
        part[4] = "changed"
        docs[i] = docs[i] + "\n" + " ".join(part)
    passage = text(rng, 14)
    shared = sorted(rng.sample([i for i in clean if i not in leaks], 6))
    for i in shared:
        docs[i] = f"start{i} " + passage + f" end{i} " + docs[i]
    copies, near = {}, {}
    rest = [i for i in clean if i not in leaks and i not in shared]
    for k in range(10):
        copies[500 + k] = rest[k]
        docs[500 + k] = docs[rest[k]]
    for k in range(10):
        # A word changed in each run of lines: runs stay too short for a passage.
        words = docs[rest[20 + k]].split()
        for at in range(20, len(words), 45):
            words[at] = f"new{k}{at}"
        near[600 + k] = rest[20 + k]
        docs[600 + k] = " ".join(words)
    folder = tmp_path_factory.mktemp("corpus")
    rows = [(i, t, "en", f"s{i % 4}", len(t)) for i, t in docs.items()]
    rows += [(700, None, None, None, None), (701, "", "en", None, 0)]
    rng.shuffle(rows)
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, int(i in toxic)) for i in range(0, 400) if i % 2]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(items.items()), "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    steps, now = [], spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in P.STAGES:
        stage(spark, now, str(folder)).write.parquet(f"{folder}/{name}")
        now = spark.read.parquet(f"{folder}/{name}")
        steps.append({r.doc_id: r for r in now.collect()})
    return {"docs": docs, "toxic": toxic, "leaks": leaks, "passage": passage, "shared": shared, "copies": copies,
            "near": near, "steps": steps, "folder": str(folder), "columns": [c for c in now.columns]}


def test_toxic_documents_go(corpus):
    kept = set(corpus["steps"][0])
    assert len(corpus["toxic"] & kept) <= 0.03 * len(corpus["toxic"])
    clean = set(corpus["docs"]) - corpus["toxic"]
    assert len(clean - kept) <= 0.02 * len(clean) and {700, 701} <= kept


def test_repeated_passages_go(corpus):
    before, after = corpus["steps"][0], corpus["steps"][1]
    first, *later = [i for i in corpus["shared"] if i in before]
    assert corpus["passage"] in after[first].text
    for i in later:
        left = after[i].text
        assert left.startswith(f"start{i} end{i} ") and left.endswith(corpus["docs"][i][-200:])
    assert not [c for c, of in corpus["copies"].items() if of in before and c in after]
    untouched = set(before) - set(later) - set(corpus["copies"]) - set(corpus["near"])
    assert all(after[i].text == before[i].text for i in untouched)


def test_near_copies_go(corpus):
    before, after = corpus["steps"][1], corpus["steps"][2]
    expected = components_of([(i, r.text) for i, r in before.items()], 5, 80)
    assert set(after) == {i for i, (_, least) in expected.items() if i == least}


def test_leaks_go(corpus):
    before, after = corpus["steps"][2], corpus["steps"][3]
    assert set(before) - set(after) == corpus["leaks"] & set(before)


def test_mix_meets_its_targets(corpus):
    before, after = corpus["steps"][3], corpus["steps"][4]
    assert set(before) == set(after)
    sizes = {i: len((r.text or "").split()) for i, r in before.items()}
    by_source: dict = {}
    for i, r in before.items():
        by_source[r.source] = by_source.get(r.source, 0) + sizes[i]
    for s, goal in targets(by_source).items():
        assert abs(sum(r.taken for r in after.values() if r.source == s) - goal) <= max(2, 0.01 * goal)


def test_mix_of_null_and_repeated_keys(spark):
    texts = [" ".join(["w"] * (5 + k)) for k in range(40)]
    rows = [(None if k % 4 == 0 else k % 7, t, "en", "ab"[k % 2], len(t)) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    out = P.mix_sources(spark, docs, "").collect()
    assert sorted(r.text for r in out) == sorted(texts)
    for r in out:
        assert r.size == len(r.text.split()) and r.taken == r.copies * r.size and r.target is not None


def test_columns_and_run(spark, corpus):
    assert corpus["columns"][:5] == ["doc_id", "text", "lang", "source", "n_chars"]
    out = P.run(spark, corpus["folder"])
    assert {r.doc_id: r.copies for r in out.collect()} == {i: r.copies for i, r in corpus["steps"][4].items()}


def test_empty_documents(spark, corpus, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{corpus['folder']}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert P.run(spark, str(tmp_path)).collect() == []


def test_registered():
    import __spark_entry__ as entry

    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
