"""BPE encoding and decoding with a tokenization automaton.

`Automaton` compiles the ordered merges of a vocabulary into a deterministic automaton over
tokens, one merge gadget after the other. It starts with one state and an arc to itself for every
letter, which spells every word letter by letter. The gadget of the merge u v -> uv takes each
path over u and then v, adds an arc uv beside it that ends where the path ends, and removes the
arc v behind u, so that the path is gone. After the last gadget the automaton has exactly one path
for every word, and the labels of its arcs are the tokens.

Where an arc ends depends on its label only, so a state is the token that leads to it. Nearly all
states have nearly all arcs; what is kept is what the gadgets removed: `cut[u, v]` is the number of
the gadget that took v behind u away. A state that a gadget makes is a copy of the state that v
leads to, as it was then, and an arc uv exists behind a state where u did then (`arc`).

Words are letters, not tokens, so the arcs are entered letter by letter: a configuration holds the
states whose next arc has been spelled in part, and how far. Transitions between configurations
are written to a table when they are first met, and looked up from then on. As every beginning of a
word has one path as well, each transition names the last arc of that path; walking these arcs back
from the end of the word gives its tokens, without any search.

Decoding joins the labels of the arcs that the ids stand for.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import sys
import unicodedata
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .common import with_arrow_columns

#: A tokenizer file is sent to every worker; larger ones are an error.
MAX_FILE_BYTES = 64 * 1024 * 1024
#: Words, and table entries, that a worker remembers before it starts anew; results do not depend on it.
WORDS_REMEMBERED = 500_000
STEPS_REMEMBERED = 1_000_000

#: The pattern that the byte-level pre-tokenizer splits with.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: The characters with the Unicode property White_Space.
WHITE_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

#: Letters and digits of Unicode 16, lower cases of 16 and 17, which Python may lack yet.
NEWER = {
    "L": (
        "1c89-1c8a a7cb-a7cd a7da-a7dc 105c0-105f3 10d4a-10d65 10d6f-10d85 10ec2-10ec4 11380-11389 "
        "1138b-1138b 1138e-1138e 11390-113b5 113b7-113b7 113d1-113d1 113d3-113d3 11bc0-11be0 "
        "13460-143fa 16100-1611d 16d40-16d6c 18cff-18cff 1e5d0-1e5ed 1e5f0-1e5f0"
    ),
    "N": "10d40-10d49 116d0-116e3 11bf0-11bf9 16130-16139 16d70-16d79 1ccf0-1ccf9 1e5f1-1e5fa",
}
NEWER_LOWER = {
    0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B,
    **{c: c + 0x20 for c in range(0x10D50, 0x10D66)}, **{c: c + 0x1B for c in range(0x16EA0, 0x16EB9)},
}

#: A pattern none of whose matches holds white space.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

START = -1
_FINAL = 256  # letters from here on are the last of their word
_TOKEN_BITS = 24
_TOKEN_MASK = (1 << _TOKEN_BITS) - 1


def byte_letters() -> list[str]:
    """The character that stands for each byte: itself if it is printable, else one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(others)) for b in range(256)]


class Automaton:
    """The automaton of a vocabulary's merges; `encode` gives the ids of one word."""

    def __init__(self, vocab: dict[str, int], merges: Sequence[Sequence[str]], suffix: str = "") -> None:
        """`merges` in the order in which they apply; `suffix` marks the last letter of a word.

        Every byte needs a token, and both sides of a merge must be letters or stem from earlier
        merges, each token from one merge only; else ValueError.
        """
        self.letters: dict[int, tuple[int, ...]] = {}
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        self.born: dict[int, int] = {}
        self.cut: dict[tuple[int, int], int] = {}
        for byte, char in enumerate(byte_letters()):
            for letter, name in ((byte, char), (_FINAL + byte, char + suffix)) if suffix else ((byte, char),):
                if name not in vocab:
                    raise ValueError(f"no token for byte {byte}")
                self.letters[vocab[name]] = (letter,)
        self.dead: set[int] = set()
        for rank, (first, second) in enumerate(merges):
            self._gadget(rank, vocab[first], vocab[second], vocab[first + second])
        if max(self.letters) > _TOKEN_MASK:
            raise ValueError("a token's id is too large")
        self._final = _FINAL if suffix else 0
        self._spell()
        self._forget()

    def _gadget(self, rank: int, u: int, v: int, uv: int) -> None:
        """Put an arc uv beside every path over u and v, and remove that path."""
        if u not in self.letters or v not in self.letters or uv in self.letters:
            raise ValueError(f"merge {rank} does not stem from earlier ones, or repeats one")
        self.letters[uv] = self.letters[u] + self.letters[v]
        if u in self.dead or v in self.dead or not self.arc(u, v):
            self.dead.add(uv)  # no path over u and v is left, so there is nothing to put an arc beside
            return
        self.left[uv], self.right[uv], self.born[uv] = u, v, rank
        self.cut[u, v] = rank

    def arc(self, state: int, label: int) -> bool:
        """Whether there is an arc `label` behind `state`.

        What the state was copied from counts up to the copy; what the label was built from counts
        up to and with the gadget that built it.
        """
        cut, born, left, right = self.cut, self.born, self.left, self.right
        copied = None
        while state is not None and state != START:
            x, built = label, None
            while x is not None:
                rank = cut.get((state, x))
                if rank is not None and (copied is None or rank < copied) and (built is None or rank <= built):
                    return False
                built, x = born.get(x), left.get(x)
            copied, state = born.get(state), right.get(state)
        return True

    def _spell(self) -> None:
        """A tree of the letters of all arcs that are left."""
        self.child: dict[int, int] = {}
        self.ends: list[int | None] = [None]
        self.inner: set[int] = set()
        for token, letters in self.letters.items():
            if token in self.dead:
                continue
            node = 0
            for letter in letters:
                self.inner.add(node)
                node = self.child.setdefault(node << 9 | letter, len(self.ends))
                if node == len(self.ends):
                    self.ends.append(None)
            self.ends[node] = token
        self.length = {t: len(x) for t, x in self.letters.items()}

    def _forget(self) -> None:
        self._configurations: list[tuple] = [((START, 0),)]
        self._numbers = {self._configurations[0]: 0}
        self._table: dict[int, int] = {}
        self._words: dict[str, bytes] = {}

    def _transition(self, number: int, letter: int) -> int:
        """The next configuration, and the last arc of the path that ends with this letter.

        Both in one integer, as the table holds many.
        """
        begun, last = [], None
        for state, node in self._configurations[number]:
            node = self.child.get(node << 9 | letter)
            if node is None:
                continue
            token = self.ends[node]
            if token is not None and last is None and self.arc(state, token):
                last = token
            if node in self.inner:
                begun.append((state, node))
        if last is None:
            raise ValueError("the automaton has no path for a word")
        after = (*begun, (last, 0))
        known = self._numbers.setdefault(after, len(self._configurations))
        if known == len(self._configurations):
            self._configurations.append(after)
        return known << _TOKEN_BITS | last

    def encode(self, word: str) -> bytes:
        """The ids of one word that the pre-tokenizer made, four bytes each, least first."""
        table, number, lasts = self._table, 0, []
        if len(table) > STEPS_REMEMBERED:
            self._forget()
            table = self._table
        data = list(word.encode("utf-8", "surrogatepass"))
        data[-1] += self._final
        for letter in data:
            step = number << 9 | letter
            entry = table.get(step)
            if entry is None:
                entry = table[step] = self._transition(number, letter)
            number = entry >> _TOKEN_BITS
            lasts.append(entry & _TOKEN_MASK)
        back, at, length = [], len(lasts), self.length
        while at:
            token = lasts[at - 1]
            back.append(token)
            at -= length[token]
        back.reverse()
        ids = struct.pack(f"<{len(back)}I", *back)
        if len(word) < 100:
            if len(self._words) > WORDS_REMEMBERED:
                self._words.clear()
            self._words[word] = ids
        return ids

    def encode_all(self, words: Iterable[str]) -> bytes:
        """The ids of words that follow each other."""
        known, encode = self._words.get, self.encode
        return b"".join([known(w) or encode(w) for w in words])

    def __getstate__(self) -> dict:
        """Without what was remembered."""
        return {k: v for k, v in self.__dict__.items() if k not in ("_configurations", "_numbers", "_table", "_words")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._forget()


class Tokenizer:
    """What a tokenizer file says: added tokens, normalisation, pre-tokenizer, merges, decoder.

    Known are the steps NFC, Replace by pattern, Lowercase, Split (removed and inverted),
    ByteLevel, and BPE without dropout, unknown token or prefix; anything else is a ValueError.
    """

    def __init__(self, described: str) -> None:
        told = json.loads(described)
        model = told["model"]
        if model["type"] != "BPE" or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges")):
            raise ValueError("only plain BPE is known")
        suffix = model.get("end_of_word_suffix") or ""
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.automaton = Automaton(model["vocab"], merges, suffix)
        self.added = {a["content"]: a["id"] for a in told.get("added_tokens") or []}
        if any(a[k] for a in told.get("added_tokens") or [] for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("only plain added tokens are known")
        names = sorted(self.added, key=len, reverse=True)
        self.split_at = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        self.steps = [self._normalizer(n) for n in _listed(told.get("normalizer"), "normalizers")]
        self.pattern = self._pre_tokenizer(_listed(told.get("pre_tokenizer"), "pretokenizers"))
        # words then never span white space, nor do the steps look across it: chunks can be remembered
        self.apart = self.pattern.pattern == compiled(WORD_PATTERN).pattern
        self._chunks: dict[str, bytes] = {}
        decoder = told.get("decoder")
        if decoder and decoder["type"] != "ByteLevel":
            raise ValueError(f"unknown decoder {decoder['type']}")
        self.bytes_out = bool(decoder)
        self.labels = {i: t for t, i in [*model["vocab"].items(), *self.added.items()]}
        if self.bytes_out:
            to_byte = {c: b for b, c in enumerate(byte_letters())}
            plain = set(self.added.values())
            self.labels = {
                i: t.encode() if i in plain else bytes(to_byte[c] for c in t) for i, t in self.labels.items()
            }

    @staticmethod
    def _normalizer(step: dict) -> Callable[[str], str]:
        if step["type"] == "NFC":
            return _nfc
        if step["type"] == "Lowercase":
            return _lower
        if step["type"] == "Replace" and "Regex" in step["pattern"]:
            return _Replace(step["pattern"]["Regex"], step["content"])
        raise ValueError(f"unknown normalizer {step['type']}")

    @staticmethod
    def _pre_tokenizer(steps: list[dict]) -> re.Pattern:
        kinds = [s["type"] for s in steps]
        if kinds == ["ByteLevel"] and steps[0]["use_regex"] and not steps[0]["add_prefix_space"]:
            return compiled(BYTE_LEVEL_PATTERN)
        if kinds == ["Split", "ByteLevel"] and not steps[1]["use_regex"] and not steps[1]["add_prefix_space"]:
            if steps[0]["behavior"] == "Removed" and steps[0]["invert"] and "Regex" in steps[0]["pattern"]:
                return compiled(steps[0]["pattern"]["Regex"])
        raise ValueError(f"unknown pre-tokenizer {kinds}")

    def _encode_part(self, part: str) -> bytes:
        """The ids of a text without added tokens."""
        if not self.apart or _CONTROLS.search(part):
            return self.automaton.encode_all(self.words(part))
        known, encode = self._chunks.get, self._encode_chunk
        return b"".join([known(c) or encode(c) for c in part.split()])

    def _encode_chunk(self, chunk: str) -> bytes:
        """The ids of what stands between white space, remembered unless it is long."""
        ids = self.automaton.encode_all(self.words(chunk))
        if len(chunk) < 100:
            if len(self._chunks) > WORDS_REMEMBERED:
                self._chunks.clear()
            self._chunks[chunk] = ids
        return ids

    def words(self, part: str) -> list[str]:
        """The pre-split words of a text without added tokens."""
        for step in self.steps:
            part = step(part)
        return self.pattern.findall(part)

    def encode(self, text: str) -> memoryview:
        """The ids of a whole text, as unsigned 32-bit integers in little-endian order."""
        found = [
            struct.pack("<I", self.added[part]) if part in self.added else self._encode_part(part)
            for part in (self.split_at.split(text) if self.split_at else [text])
        ]
        return memoryview(found[0] if len(found) == 1 else b"".join(found))

    def decode(self, ids: Iterable[int]) -> str:
        """The labels of `ids`; ids without token are left out."""
        try:
            labels = [self.labels[i] for i in ids]
        except KeyError:
            labels = [self.labels[i] for i in ids if i in self.labels]
        return b"".join(labels).decode("utf-8", "replace") if self.bytes_out else " ".join(labels)

    def __getstate__(self) -> dict:
        """Without what was remembered."""
        return {**self.__dict__, "_chunks": {}}


def numbers(ids: memoryview) -> list[int]:
    """The ids that `Tokenizer.encode` gives, as integers."""
    return list(struct.unpack(f"<{ids.nbytes // 4}I", ids))


def _listed(step: dict | None, of: str) -> list[dict]:
    return [] if step is None else step[of] if step["type"] == "Sequence" else [step]


@cache
def _category_class(letter: str) -> str:
    """The characters of a general category, as the inside of a character class."""
    runs, start = [], None
    for code in range(sys.maxunicode + 2):
        inside = code <= sys.maxunicode and unicodedata.category(chr(code))[0] == letter
        if inside and start is None:
            start = code
        elif not inside and start is not None:
            runs.append(f"\\U{start:08x}-\\U{code - 1:08x}")
            start = None
    for first, last in (r.split("-") for r in NEWER[letter].split()):
        runs.append(f"\\U{first:>08}-\\U{last:>08}")
    return "".join(runs)


def compiled(pattern: str) -> re.Pattern:
    """`pattern` with \\p{L}, \\p{N} and \\s meaning the Unicode properties, for the `re` module."""
    inside = {r"\p{L}": _category_class("L"), r"\p{N}": _category_class("N"), r"\s": WHITE_SPACE}

    def spelled(match: re.Match) -> str:
        if match[0].startswith("["):
            return re.sub(r"\\p\{[LN]\}|\\s", lambda m: inside[m[0]], match[0])
        return f"[^{WHITE_SPACE}]" if match[0] == r"\S" else f"[{inside[match[0]]}]"

    return re.compile(re.sub(r"\[[^\]]*\]|\\p\{[LN]\}|\\s|\\S", spelled, pattern))


def _nfc(text: str) -> str:
    return unicodedata.normalize("NFC", text)


def _lower(text: str) -> str:
    """Lower case character by character, so a sigma at the end of a word is like any other."""
    lower = text.replace("Σ", "σ").lower()
    return lower.translate(NEWER_LOWER) if _NEWER_UPPER.search(lower) else lower


#: What str.split takes for white space though it has not that property.
_CONTROLS = re.compile("[\x1c-\x1f]")
_NEWER_UPPER = re.compile("[" + "".join(map(chr, NEWER_LOWER)) + "]")


class _Replace:
    def __init__(self, pattern: str, by: str) -> None:
        self.pattern, self.by = compiled(pattern), by.replace("\\", r"\\")

    def __call__(self, text: str) -> str:
        return self.pattern.sub(self.by, text)


def tokenizer_file(spark: SparkSession, path: str) -> str:
    """The text of a tokenizer file that Spark can read; one beyond MAX_FILE_BYTES is an error."""
    found = spark.read.format("binaryFile").load(path).select("length").head(2)
    if len(found) != 1 or found[0]["length"] > MAX_FILE_BYTES:
        raise ValueError(f"{path}: one file of at most {MAX_FILE_BYTES} bytes is wanted")
    return bytes(spark.read.format("binaryFile").load(path).select("content").head()[0]).decode()


def load(spark: SparkSession, described: str):
    """The tokenizer that a file's text describes, compiled once and sent to the workers.

    Its size follows from the vocabulary alone, and texts beyond MAX_FILE_BYTES are an error.
    """
    if len(described) > MAX_FILE_BYTES:
        raise ValueError(f"a tokenizer file has at most {MAX_FILE_BYTES} bytes")
    return spark.sparkContext.broadcast(Tokenizer(described))


def encode(docs: DataFrame, tokenizer, text: str = "text", ids: str = "ids") -> DataFrame:
    """`docs` with the ids of each whole text in column `ids`, which replaces one of that name.

    `tokenizer` comes from `load`. A null text counts as empty, an empty one has no ids. Rows are
    independent of each other: repeated rows, other columns and empty tables need no care.
    """

    def make() -> Callable[[pa.RecordBatch], list[pa.Array]]:
        known = tokenizer.value

        def run(batch: pa.RecordBatch) -> list[pa.Array]:
            found = (known.encode(t or "") for t in batch.column(text).to_pylist())
            return [pa.array([numbers(x) for x in found], pa.list_(pa.int32()))]

        return run

    return with_arrow_columns(docs, [T.StructField(ids, T.ArrayType(T.IntegerType()))], make, reads=[text])


def decode(encoded: DataFrame, tokenizer, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """`encoded` with the text that each row's ids stand for; null ids count as none."""

    def make() -> Callable[[pa.RecordBatch], list[pa.Array]]:
        known = tokenizer.value

        def run(batch: pa.RecordBatch) -> list[pa.Array]:
            return [pa.array([known.decode(x or ()) for x in batch.column(ids).to_pylist()], pa.string())]

        return run

    return with_arrow_columns(encoded, [T.StructField(text, T.StringType())], make, reads=[ids])


def round_trip(docs: DataFrame, tokenizer, text: str = "text") -> DataFrame:
    """`docs` without `text`, with n_tokens, ids_sha256 and decoded_sha256: encoded, then decoded.

    One pass; the ids of one text at a time are held. Ids are hashed as little-endian unsigned
    32-bit integers, the decoded text in UTF-8.
    """

    def make() -> Callable[[pa.RecordBatch], list[pa.Array]]:
        known = tokenizer.value

        def digests(value: str | None) -> tuple[int, str, str]:
            ids = known.encode(value or "")
            back = known.decode(numbers(ids)).encode("utf-8", "surrogatepass")
            return ids.nbytes // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(back).hexdigest()

        def run(batch: pa.RecordBatch) -> list[pa.Array]:
            made = [digests(t) for t in batch.column(text).to_pylist()]
            return [pa.array([m[k] for m in made], kind) for k, kind in enumerate((pa.int64(), pa.string(), pa.string()))]

        return run

    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    return with_arrow_columns(docs, fields, make, reads=[text], keep=[c for c in docs.columns if c != text])
