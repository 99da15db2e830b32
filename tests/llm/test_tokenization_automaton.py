"""The automaton against the tokenizers library, and against merging by hand."""

from __future__ import annotations

import hashlib
import json
import random
from array import array
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from galegrid.llm import tokenization_automaton as ta
from galegrid.llm.queries import op11_bpe_round_trip, tokenizer_path

tokenizers = pytest.importorskip("tokenizers")
FILES = ("word_bpe_49k.json", "byte_bpe_50k.json")
TEXTS = [
    None, "", " ", "a", "It's we'll x's 's't", "<|startoftext|>Hi<|endoftext|> there <|ENDOFTEXT|>", "ΑΣ ΣΑΣ İstanbul",
    "é é à́", "\x1c a\x85b​c 　 d", "aaaaa " * 3000, "a" * 20000, "日本語 12345 ½ ⅷ 🙂🙂 \U0001f9d1‍\U0001f4bb",
    "Ɤ \U00010d50 \U00013460x", "...!!!???---", "\n\n\t x \r\n y",
]


def path(name):
    return str(Path(tokenizer_path()).with_name(name))


@pytest.fixture(scope="module", params=FILES)
def both(request):
    return ta.Tokenizer(Path(path(request.param)).read_text("utf-8")), tokenizers.Tokenizer.from_file(path(request.param))


def test_texts_as_the_library(both):
    ours, theirs = both
    for text in TEXTS:
        ids = ta.numbers(ours.encode(text or ""))
        assert ids == theirs.encode(text or "", add_special_tokens=False).ids, text
        assert ours.decode(ids) == theirs.decode(ids, skip_special_tokens=False)
    chance = random.Random(5)
    for _ in range(3000):
        word = "".join(chance.choice("ethaoinsrl'9é日 X") for _ in range(chance.randint(1, 30)))
        assert ta.numbers(ours.encode(word)) == theirs.encode(word, add_special_tokens=False).ids, word


def test_characters_as_the_library(both):
    ours, theirs = both
    for code in [*range(0x3000), *range(0x3000, 0x20000, 7), *range(0x20000, 0x110000, 997)]:
        if not 0xD800 <= code < 0xE000:
            text = f"a{chr(code)}B {chr(code)}{chr(code)}1"
            assert ta.numbers(ours.encode(text)) == theirs.encode(text, add_special_tokens=False).ids, hex(code)


def merged(word: str, merges, suffix: str) -> list[str]:
    """Every merge in its order, from left to right."""
    parts = list(word)
    parts[-1] += suffix
    for u, v in merges:
        i = 0
        while i < len(parts) - 1:
            if parts[i] == u and parts[i + 1] == v:
                parts[i : i + 2] = [u + v]
            i += 1
    return parts


@pytest.mark.parametrize("seed", range(30))
def test_any_merges_as_by_hand(seed):
    """Also merges that never apply, as others take one side first, and merges of equal sides."""
    chance, suffix = random.Random(seed), "</w>" if seed % 2 else ""
    letters = [c + s for c in ta.byte_letters() for s in {"", suffix}]
    made, merges = [c + s for c in "ab" for s in {"", suffix}] + ["c"], []
    while len(merges) < 25:
        u, v = chance.choice(made), chance.choice(made)
        if u + v not in made and not (suffix and u.endswith(suffix)) and len(u + v) < 20:
            merges.append((u, v))
            made.append(u + v)
    vocab = {t: i for i, t in enumerate(dict.fromkeys([*letters, *made]))}
    names = {i: t for t, i in vocab.items()}
    automaton = ta.Automaton(vocab, merges, suffix)
    for _ in range(400):
        word = "".join(chance.choice("abc") for _ in range(chance.randint(1, 14)))
        ids = array("I", automaton.encode(word))
        assert [names[i] for i in array("I", automaton.encode(word))] == merged(word, merges, suffix), (word, merges, ids)


def test_small_memory_gives_the_same(monkeypatch, both):
    ours, _ = both
    words = [f"{a}{b}" for a in ("super", "inter", "xq") for b in ("national", "cali", "zzz")] * 3
    before = [bytes(ours.automaton.encode(w)) for w in words]
    monkeypatch.setattr(ta, "WORDS_REMEMBERED", 2)
    monkeypatch.setattr(ta, "STEPS_REMEMBERED", 5)
    assert [bytes(ours.automaton.encode(w)) for w in words] == before
    assert len(ours.automaton._words) <= 3


def test_what_is_unknown_is_an_error():
    told = json.loads(Path(path(FILES[0])).read_text("utf-8"))
    with pytest.raises(ValueError, match="plain BPE"):
        ta.Tokenizer(json.dumps({**told, "model": {**told["model"], "dropout": 0.1}}))
    with pytest.raises(ValueError, match="decoder"):
        ta.Tokenizer(json.dumps({**told, "decoder": {"type": "Metaspace"}}))
    with pytest.raises(ValueError, match="earlier"):
        ta.Automaton({**told["model"]["vocab"], "xyz": 50000, "yz": 50001}, [("x", "yz"), ("y", "z")], "</w>")


def test_query_as_the_library(spark, sf_dir):
    found = {r["doc_id"]: r for r in op11_bpe_round_trip(spark, sf_dir).collect()}
    theirs = tokenizers.Tokenizer.from_file(tokenizer_path())
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert len(found) == len(docs)
    for doc in docs:
        ids = theirs.encode(doc["text"] or "", add_special_tokens=False).ids
        row = found[doc["doc_id"]]
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(theirs.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_frames(spark):
    """Nulls, repeated rows, an empty table, columns with the names of the new ones."""
    tokenizer = ta.load(spark, ta.tokenizer_file(spark, path(FILES[1])))
    rows = [(1, "Hello there", 5, "k0"), (1, "Hello there", 5, "k0"), (None, None, None, None), (2, "", 1, "r0")]
    docs = spark.createDataFrame(rows, "id int, text string, IDS int, k0 string")
    encoded = ta.encode(docs, tokenizer)
    assert encoded.columns == ["id", "text", "k0", "ids"]
    back = ta.decode(encoded, tokenizer, text="text").select("id", "k0", F.size("ids").alias("n"), "text").collect()
    assert sorted(map(tuple, back), key=str) == sorted(
        [(1, "k0", 2, "Hello there"), (1, "k0", 2, "Hello there"), (None, None, 0, ""), (2, "r0", 0, "")], key=str
    )
    assert ta.round_trip(docs.limit(0), tokenizer).count() == 0
    assert ta.round_trip(docs.limit(0), tokenizer).columns == ["id", "IDS", "k0", "n_tokens", "ids_sha256", "decoded_sha256"]
