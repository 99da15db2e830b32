from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from galegrid.llm import line_dedup as L

SCHEMA = "doc_id bigint, text string, n_runs string"


def sentences(rng, n, lo=4, hi=9):
    return [" ".join(f"{rng.choice('abcdefgh')}{rng.randrange(10**6)}" for _ in range(rng.randint(lo, hi))) + "." for _ in range(n)]


def cleaned(spark, texts):
    rows = [(i, t, "old") for i, t in enumerate(texts)]
    return {r.doc_id: r.text for r in L.line_dedup(spark.createDataFrame(rows, SCHEMA)).collect()}


def test_repeats_go_and_the_first_stays(spark):
    rng = random.Random(4)
    passage = " ".join(sentences(rng, 14))
    texts = [" ".join(sentences(rng, 10)) for _ in range(30)]
    texts[3] = "Intro one. " + passage + " Tail words here."
    texts[9] = "first " + passage + " and on"  # inside a line, at both ends
    texts[11] = texts[11] + "\n" + passage + "\n" + texts[12]
    texts[20] = texts[3]
    found = cleaned(spark, texts)
    assert found[3] == texts[3]
    assert found[9].split() == ["first", "and", "on"]
    assert passage not in found[11] and texts[11].split("\n")[0] in found[11]
    assert found[12] == texts[12].replace(texts[12], found[12]) and found[20] == ""
    for i in set(range(30)) - {9, 11, 12, 20}:
        assert found[i] == texts[i]


def test_short_repeats_stay(spark):
    rng = random.Random(5)
    short = " ".join(sentences(rng, 4))  # at most 36 words
    texts = [" ".join([*sentences(rng, 6), short, *sentences(rng, 6)]) for _ in range(8)]
    assert cleaned(spark, texts) == dict(enumerate(texts))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force(spark, seed):
    """No later run of 3 whole lines and 50 words is left, and nothing else went."""
    rng = random.Random(seed)
    pool = [sentences(rng, rng.randint(12, 20)) for _ in range(4)]
    texts = []
    for _ in range(40):
        parts = sentences(rng, rng.randint(0, 8))
        for _ in range(rng.randint(0, 2)):
            parts += rng.choice(pool)
            parts += sentences(rng, rng.randint(0, 3))
        texts.append(rng.choice((" ", "\n")).join(parts))
    found = cleaned(spark, texts)

    def grams(text):
        w = text.split()
        return [" ".join(w[i : i + 50]) for i in range(len(w) - 49)]

    first = {}
    for i, t in enumerate(texts):
        for at, g in enumerate(grams(t)):
            first.setdefault(g, (i, at))
    covered = {i: set() for i in range(40)}
    for i, t in enumerate(texts):
        for at, g in enumerate(grams(t)):
            if first[g] != (i, at):
                covered[i] |= set(range(at, at + 50))
    for i, t in enumerate(texts):
        w = t.split()
        assert found[i].split() == [x for k, x in enumerate(w) if k not in covered[i]], i


def test_repeats_inside_a_document(spark):
    rng = random.Random(7)
    passage = " ".join(sentences(rng, 12))
    text = "Head line.\n" + passage + "\n" + "Middle of it.\n" + passage + "\n" + "End."
    found = cleaned(spark, [text])[0]
    assert found.count(passage) == 1 and "Middle of it." in found and found.startswith("Head line.")
    again = cleaned(spark, ["ab cd ef.\n" * 500])[0]
    assert again.startswith("ab cd ef.") and len(again) <= 200


def test_nulls_empties_and_repeated_rows(spark):
    rng = random.Random(8)
    long = " ".join(sentences(rng, 3000))
    rows = [(1, None, "x"), (2, "", "x"), (3, "\n\n", "x"), (None, long, "x"), (4, long, None), (4, long, None), (5, "one", None)]
    out = L.line_dedup(spark.createDataFrame(rows, SCHEMA))
    assert out.columns == ["doc_id", "text", "n_runs"] and dict(out.dtypes)["n_runs"] == "int"
    found = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    assert found == sorted([(1, None), (2, ""), (3, "\n\n"), (None, long), (4, long), (4, long), (5, "one")], key=str)
    assert L.line_dedup(spark.createDataFrame([], SCHEMA)).collect() == []


def test_lines_give_the_text_back(spark):
    texts = ["a. b, c\n\nd;  e! f? g: h", " lead. ", "\n", "no end", "x.y z. "]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.array_join(L._lines(F.col("t")), "").alias("u"))
    assert all(r.t == r.u for r in df.collect())


def names(rng, n):
    return [f"{rng.choice('abcdefgh')}{rng.randrange(10**6)}" for _ in range(n)]


def test_short_whole_lines_between_long_cut_ones(spark):
    rng = random.Random(11)
    w = names(rng, 52)
    for k in (19, 20, 23, 31):  # whole lines of 1, 3 and 8 words, the rest in lines cut at both ends
        w[k] += ","
    texts = [" ".join([*names(rng, 9), *w, *names(rng, 9)]) for _ in range(2)]
    found = cleaned(spark, texts)
    assert found[0] == texts[0] and found[1].split() == [x for x in texts[1].split() if x not in w]


@pytest.mark.parametrize("seed", [1, 2])
def test_passage_whose_parts_came_before_in_excerpts(spark, seed):
    rng = random.Random(seed)
    passage = [" ".join(names(rng, 8)) + "." for _ in range(8)]
    texts = [" ".join([*sentences(rng, 3), *passage[k : k + 3], *sentences(rng, 3)]) for k in range(6)]
    texts += [" ".join([*sentences(rng, 3), *passage, *sentences(rng, 3)]) for _ in range(2)]
    found = cleaned(spark, texts)
    assert [found[k] for k in range(7)] == texts[:7]
    gone = set(" ".join(passage).split())
    assert found[7].split() == [x for x in texts[7].split() if x not in gone]


@pytest.mark.parametrize("size", [50, 70])
def test_passages_in_text_without_full_stops(spark, size):
    rng = random.Random(size)
    for end in ("", ";", "\uff0c", ".###")[:: 1 if size == 50 else 3]:
        w = [x + (end if k % 7 == 6 else "") for k, x in enumerate(names(rng, size))]
        texts = [" ".join([*names(rng, 40), *w, *names(rng, 40)]) for _ in range(2)]
        texts.append(texts[0].replace(" ", "\t\t"))  # words stand between white space of any kind
        found = cleaned(spark, texts)
        assert found[0] == texts[0] and found[2] == ""
        assert found[1].split() == [x for x in texts[1].split() if x not in w]


def test_rows_of_one_key_keep_their_own_words(spark):
    """Different texts under one key are told apart; columns with the names of helpers stay."""
    rng = random.Random(4)
    copied, unique = names(rng, 80), names(rng, 200)
    rows = [(1, " ".join(copied)), (7, " ".join([*names(rng, 10), *copied])), (7, " ".join(unique)), (8, " ".join(unique[20:90]))]
    df = spark.createDataFrame(rows, "doc_id int, text string").withColumns({"_cuts": F.lit("c"), "_l": F.lit(1), "_ROW": F.lit(2)})
    found = L.line_dedup(df)
    assert found.columns == ["doc_id", "text", "_cuts", "_l", "_ROW", "n_runs"]
    assert sorted(len(r.text.split()) for r in found.collect()) == [0, 10, 80, 200]


def test_lines_are_found_by_what_they_say(spark):
    """Batch by batch, not word by word: each 50 words hold a whole line, the same words the same one."""
    pick = random.Random(5)
    shared = [f"w{pick.randrange(30)}" for _ in range(90)]
    long = [f"v{pick.randrange(9)}é" for _ in range(200)]
    texts = [" ".join(shared), "\t".join(["x"] * 7 + shared) + "\n", " \n" + "  ".join(long), "a b", None, "y " * 49, "y " * 50]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = L.fingerprints(docs)
    assert "MapInArrow" in found._jdf.queryExecution().executedPlan().toString()
    lines = {k: [] for k in range(len(texts))}
    for r in sorted(found.collect(), key=lambda r: (r["doc"], r["at"])):
        lines[r["doc"]].append(r)
    assert not lines[3] and not lines[4] and not lines[5] and [(r["at"], r["start"], r["end"]) for r in lines[6]] == [(25, 1, 50)]
    for k, n in ((0, 90), (1, 97), (2, 200)):
        at = [r["at"] for r in lines[k]]
        assert all(any(p <= a and a + 25 <= p + 49 for a in at) for p in range(1, n - 48))
        assert all(r["start"] == max(r["at"] - 24, 1) and r["end"] == min(r["at"] + 49, n) for r in lines[k])
    first, second = ({r["at"] - gap: (r["g"], r["end"] - r["at"]) for r in lines[k]} for k, gap in ((0, 0), (1, 7)))
    assert all(second[a] == v for a, v in first.items())


def test_no_python_runs_on_the_executors(spark, monkeypatch):
    """The query's lines are Spark's own, and every part that it writes on the way."""
    rng = random.Random(9)
    shared = names(rng, 90)
    texts = [" ".join([*names(rng, 30), *shared, *names(rng, 30)]) for _ in range(3)]
    plans, cut = [], L.cut_lineage

    def noted(df, *args, **kwargs):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return cut(df, *args, **kwargs)

    monkeypatch.setattr(L, "cut_lineage", noted)
    out = L.line_dedup(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    plans.append(out._jdf.queryExecution().optimizedPlan().toString())
    assert len(plans) > 3 and not any(x in p for p in plans for x in ("MapInArrow", "Python", "Pandas"))
    assert sorted(len(r.text.split()) for r in out.collect()) == [60, 60, 150]


@pytest.mark.parametrize("words", [30, 3, 1, 10**6])
def test_each_passage_holds_an_opened_line(spark, words):
    """Also where few words, or one, come again and again, and where no word's hash is small."""
    rng = random.Random(words)
    shared = [f"w{rng.randrange(words)}" for _ in range(140)]
    texts = [" ".join(shared), " ".join([f"v{k}" for k in range(7)] + shared + ["end"] * 5), " ".join(shared[:49])]
    found = L.openers(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    lines = [{r["at"]: r["g"] for r in found if r["doc"] == k} for k in range(3)]
    assert not lines[2] and len(found) == sum(map(len, lines))
    assert max(lines[0]) + L.OPENED_WORDS - 1 <= 140
    for s in range(1, 140 - 48):
        inside = [a for a in range(s, s + L.STEP) if a in lines[0]]
        assert any(lines[1].get(a + 7) == lines[0][a] for a in inside)


def test_one_line_with_different_words_around(spark):
    """A short line stands between many others; passages through it are found wherever they came before."""
    rng = random.Random(12)
    line = names(rng, 20)
    left, right = [names(rng, 45) for _ in range(3)], [names(rng, 45) for _ in range(3)]
    texts = [[*left[k % 3], *line, *right[k // 3]] for k in range(9)]
    rng.shuffle(texts)
    first, expected = {}, []
    for i, w in enumerate(texts):
        gone = set()
        for s in range(len(w) - 49):
            if first.setdefault(tuple(w[s : s + 50]), (i, s)) != (i, s):
                gone |= set(range(s, s + 50))
        expected.append([x for k, x in enumerate(w) if k not in gone])
    found = cleaned(spark, [" ".join(w) for w in texts])
    assert [found[k].split() for k in range(9)] == expected and any(len(e) < 110 for e in expected)
