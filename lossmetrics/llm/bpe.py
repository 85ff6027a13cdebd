"""Byte-pair encoding and decoding with a published vocabulary.

Encoding walks a trie of the distinct words of a block depth first. The state of a trie node is the last token of the
encoding of its prefix: the one vocabulary entry that ends the prefix and that no merge would join to the encoding before
it. Words with a common prefix share those states, so a prefix is encoded once, and the tokens of a word are read off by
stepping back from its last token. The result equals that of merging pairs by rank.

A node's candidates are the vocabulary entries that end its prefix. They follow from the longest end of the prefix that begins
an entry, which is handed from node to node beside the state.

A distinct word is encoded and decoded once and kept: a text's ids, their decimal form and its decoded form are the joined
ones of its words, as the vocabulary drops white space and decodes token by token. All directions are map-only: no shuffle,
no group, a bounded cache of words per Python worker.

What is a letter or a number, and which lower case a letter has, differs between Unicode versions. The driver asks the
library for its own answers, in one call over all code points, and sends them along with the vocabulary.

Defined cases: a null or empty text has no tokens and decodes to an empty string; repeated rows are encoded alike; an
empty table gives an empty table; a column that is already named like the result is replaced; ids outside the vocabulary
are skipped by the decoder.
"""

from __future__ import annotations

import functools
import gc
import hashlib
import json
import os
import re
import sys
import unicodedata
from array import array
from collections import deque
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, DataType, IntegerType, LongType, StringType, StructField

from lossmetrics.llm.batches import assemble, blocks, give_back, with_fields

#: Words kept per Python worker, beyond which only those of the last blocks stay, and facts kept about pairs of tokens and prefixes.
CACHE_WORDS, CACHE_FACTS = 400_000, 300_000
#: Bytes of text encoded at once.
BLOCK = 1 << 20
_NEVER = 1 << 60
#: White space as the vocabulary's pattern has it; fixed values. Python's own class holds four control characters more.
_WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Ends the last symbol of a word inside this module; the byte alphabet has no space.
_END = " "


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else the next from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


def _every_code_point() -> list[str]:
    """All code points but the surrogates, which no text holds."""
    return [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]


@functools.cache
def library_tables() -> dict[str, dict]:
    """Ranges of letters and of numbers, and the lower cases that differ from Python's, as the library has them."""
    from tokenizers import Regex, normalizers, pre_tokenizers

    points = _every_code_point()
    text = "".join(points)
    found: dict[str, dict] = {}
    for name in ("L", "N"):
        split = pre_tokenizers.Split(Regex(f"[\\p{{{name}}}]+"), "removed", invert=True)
        found[name] = {text[start]: text[end - 1] for _, (start, end) in split.pre_tokenize_str(text)}
    lowered = normalizers.Lowercase().normalize_str("\n".join(c for c in points if c != "\n")).split("\n")
    found["lower"] = {c: low for c, low in zip((c for c in points if c != "\n"), lowered) if low != c.lower() and c != "Σ"}
    return found


def character_class(ranges: dict[str, str], last: int = sys.maxunicode) -> str:
    """Ranges of code points (first to last) up to ``last``, as a pattern writes them."""
    return "".join(f"\\U{ord(a):08x}-\\U{min(ord(b), last):08x}" for a, b in ranges.items() if ord(a) <= last)


def word_pattern(split: str, tables: dict[str, dict], last: int = sys.maxunicode) -> re.Pattern:
    """The vocabulary's own pattern with white space, letters and numbers spelled out, for texts of code points up to ``last``."""
    # Letters first, as most words are: the other alternatives begin with other symbols, so their order stays right.
    letters = "[\\p{L}]+"
    parts = split.split("|")
    if letters in parts and all(p.startswith("'") for p in parts[: parts.index(letters)]):
        split = "|".join([letters, *(p for p in parts if p != letters)])
    found = split.replace("\\s", _WHITE)
    for name in ("L", "N"):
        found = found.replace(f"\\p{{{name}}}", character_class(tables[name], last))
    return re.compile(found)


class Vocabulary:
    """A word-end BPE vocabulary file and the compatibility of its tokens."""

    def __init__(self, definition: str, tables: dict[str, dict] | None = None):
        spec, tables = json.loads(definition), tables or library_tables()
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        steps = [n["type"] for n in spec["normalizer"]["normalizers"]]
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        if model["type"] != "BPE" or not self.suffix or steps != ["NFC", "Replace", "Lowercase"] or not split["invert"]:
            raise ValueError("the file does not hold a lower-casing BPE vocabulary with word ends")
        # The classes of higher planes are long lists of ranges, which few texts need.
        self.pieces, self.low_pieces, self.ascii_pieces = (word_pattern(split["pattern"]["Regex"], tables, last) for last in (sys.maxunicode, 0xFFFF, 0x7F))
        odd = character_class({c: c for c in tables["lower"]}, 0xFFFF)
        self.rare = re.compile(f"[{odd}\\U00010000-\\U0010ffff]")
        self.odd_lower = {ord(c): low for c, low in tables["lower"].items()}
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        found = sorted(self.specials, key=len, reverse=True)
        self.special_pattern = re.compile("(" + "|".join(map(re.escape, found)) + ")") if found else None
        self.special_mark = os.path.commonprefix(found)
        self.ids = {self._inner(t): i for t, i in model["vocab"].items()}
        self.alphabet = byte_alphabet()
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.rank: dict[tuple[str, str], int] = {}
        self.halves: dict[str, tuple[str, str, int]] = {}
        for order, (left, right) in enumerate(pairs):
            left, right = self._inner(left), self._inner(right)
            self.rank.setdefault((left, right), order)
            self.halves.setdefault(left + right, (left, right, order))
        self._right: dict[str, list[tuple[str, int]]] = {}
        self._left: dict[str, list[tuple[str, int]]] = {}
        #: By token: whether a token before it fits.
        self._fits: dict[str, dict[str, bool]] = {}
        self._facts = 0
        # Only tokens that encode to themselves can occur.
        whole: dict[str, bool] = {}
        for token in sorted(self.ids, key=len):
            made = self.halves.get(token)
            whole[token] = made is None or (
                whole.get(made[0], False) and whole.get(made[1], False) and not self._joined(made[0], made[1], made[2])
            )
        self.tokens = {t for t, ok in whole.items() if ok}
        if not self.tokens.issuperset(self.alphabet):
            raise ValueError("the vocabulary has no token for a byte")
        #: What a vocabulary entry can begin with, and what follows from the end of a prefix (see ``_step``).
        self.beginnings = {t[:k] for t in self.tokens for k in range(1, len(t) + 1)}
        self._steps: dict[str, tuple[str, tuple[tuple[str, int, bytes, dict[str, bool]], ...]]] = {}
        self._numbers = {t: array("i", [i]).tobytes() for t, i in self.ids.items()}
        self._token = {i: t for t, i in self.ids.items()}
        self._stored = np.zeros(0, "i4, i4, ?")
        self._symbols = {n: c for n, c in enumerate(self.alphabet)}
        self.names = {i: t for t, i in model["vocab"].items()} | {i: t for t, i in self.specials.items()}

    def _inner(self, token: str) -> str:
        return token[: -len(self.suffix)] + _END if token.endswith(self.suffix) else token

    def _edge(self, token: str, side: int) -> list[tuple[str, int]]:
        """The tokens that stand at one edge of ``token`` while it is built, each with the rank of the merge that takes it up."""
        chain, taken = [], _NEVER
        while True:
            chain.append((token, taken))
            made = self.halves.get(token)
            if made is None:
                return chain
            token, taken = made[side], made[2]

    def _joined(self, a: str, b: str, before: int) -> bool:
        """Whether a merge of rank under ``before`` joins the text of ``a`` and ``b`` across their border."""
        right = self._right.get(a) or self._right.setdefault(a, self._edge(a, 1))
        left = self._left.get(b) or self._left.setdefault(b, self._edge(b, 0))
        for x, x_taken in right:
            for y, y_taken in left:
                order = self.rank.get((x, y))
                # Of equal ranks the left place merges first.
                if order is not None and order < x_taken and order <= y_taken and order < before:
                    return True
        return False

    def fits(self, a: str, b: str) -> bool:
        """Whether the encoding of the two tokens' text is these two tokens."""
        before = self._fits.setdefault(b, {})
        known = before.get(a)
        if known is None:
            if self._facts > CACHE_FACTS:
                self._clear_fits()
            self._facts += 1
            known = before[a] = not self._joined(a, b, _NEVER)
        return known

    def _clear_fits(self) -> None:
        for before in self._fits.values():  # steps refer to these
            before.clear()
        self._facts = 0

    def _step(self, prefix: str) -> tuple[str, tuple[tuple[str, int, bytes, dict[str, bool]], ...]]:
        """The longest end of a prefix that begins an entry, and the entries that end the prefix, longest first, with their lengths, ids and what fits before them."""
        end = prefix
        while end and end not in self.beginnings:
            end = end[1:]
        found = (end[k:] for k in range(len(end)))
        known = end, tuple((t, len(t), self._numbers[t], self._fits.setdefault(t, {})) for t in found if t in self.tokens)
        if len(self._steps) > CACHE_FACTS:
            self._steps.clear()
        self._steps[prefix] = known
        return known

    def store(self) -> None:
        """Put the facts about pairs of tokens away as numbers, so that the memory of the words among them can be given back."""
        facts = ((self.ids[a], self.ids[b], fit) for b, before in self._fits.items() for a, fit in before.items())
        self._stored = np.fromiter(facts, "i4, i4, ?")
        self._steps.clear()
        self._fits.clear()
        self._facts = 0

    def restore(self) -> None:
        if len(self._stored):
            token = self._token.__getitem__
            for a, b, fit in self._stored.tolist():
                self._fits.setdefault(token(b), {})[token(a)] = fit
            self._facts = len(self._stored)
            self._stored = self._stored[:0]

    def _coded(self, word: str) -> str:
        """A word in the byte alphabet."""
        return word if word.isascii() and word.isprintable() else word.encode().decode("latin-1").translate(self._symbols)

    def encode_words(self, words: Iterable[str]) -> dict[str, bytes]:
        """Ids of every distinct word as packed 32-bit integers: a depth-first walk of the words' trie in sorted order.

        A node of the path holds the last token of its prefix, the longest end that begins an entry, and the prefix's ids.
        """
        coded = {self._coded(word): word for word in words}
        steps, step_of, fits = self._steps, self._step, self.fits
        out: dict[str, bytes] = {}
        nodes: list[tuple[str, str, bytes]] = [("", "", b"")]
        path = ""
        for text in sorted(coded):
            inner = len(text) - 1
            depth = 0
            for a, b in zip(path, text):
                if a != b:
                    break
                depth += 1
            if depth > inner:  # the last symbol ends the word, so it is no inner symbol
                depth = inner
            del nodes[depth + 1 :]
            at = nodes[depth][1]
            end = depth
            for symbol in text[depth:inner]:
                end += 1
                key = at + symbol
                at, candidates = steps.get(key) or step_of(key)
                for token, size, number, known in candidates:
                    if size == end:
                        nodes.append((token, at, number))
                        break
                    before, _, ids = nodes[end - size]
                    fit = known.get(before)
                    if fit or (fit is None and fits(before, token)):
                        nodes.append((token, at, ids + number))
                        break
            path = text[:inner]
            key = at + text[inner] + _END
            for token, size, number, known in (steps.get(key) or step_of(key))[1]:
                if size == inner + 2:
                    out[coded[text]] = number
                    break
                before, _, ids = nodes[inner + 2 - size]
                fit = known.get(before)
                if fit or (fit is None and fits(before, token)):
                    out[coded[text]] = ids + number
                    break
        return out

    def words_of(self, text: str) -> list[str]:
        """The words of a text without special tokens, normalised."""
        if text.isascii():
            return self.ascii_pieces.findall(text.lower())
        plain = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        if self.rare.search(plain):
            return self.pieces.findall(plain.translate(self.odd_lower))
        return self.low_pieces.findall(plain)


#: What can be kept of a word: a function of its packed ids and the vocabulary's names, and what stands between two words of a text.
_VIEWS: dict[str, tuple[Callable[[bytes, dict[int, str]], bytes], bytes]] = {
    "packed": (lambda ids, names: ids, b""),
    "decimal": (lambda ids, names: " ".join(map(str, array("i", ids))).encode(), b" "),
    "decoded": (lambda ids, names: " ".join(map(names.__getitem__, array("i", ids))).encode(), b" "),
}


class Encoder:
    """Encodes blocks of texts; keeps the asked views of recent words."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.kept: dict[str, dict[str, bytes]] = {}
        self.recent: deque[set[str]] = deque(maxlen=8)

    def _learn(self, words: set[str]) -> None:
        known = self.vocabulary.encode_words(words)
        names = self.vocabulary.names
        for view, kept in self.kept.items():
            make = _VIEWS[view][0]
            for word, ids in known.items():
                kept[word] = make(ids, names)
            for content, number in self.vocabulary.specials.items():
                kept["\n" + content] = make(array("i", [number]).tobytes(), names)

    def _split(self, text: str) -> list[str]:
        """Words and special tokens of a text in order; special tokens have a line feed before them, which no word holds."""
        special = self.vocabulary.special_pattern
        if special is None or self.vocabulary.special_mark not in text or not special.search(text):
            return self.vocabulary.words_of(text)
        found: list[str] = []
        for k, piece in enumerate(special.split(text)):
            found += ["\n" + piece] if k % 2 else self.vocabulary.words_of(piece)
        return found

    def forget(self) -> None:
        """Drop what was learnt: a worker lives on after its task, beside the executor's heap."""
        self.kept.clear()
        self.recent.clear()
        self.vocabulary.store()
        give_back()

    def views(self, texts: Sequence[str | None], names: Sequence[str] = ("packed",)) -> dict[str, list[bytes]]:
        """The asked views of every text: packed 32-bit ids, their decimal form, the decoded text."""
        if set(self.kept) != set(names):
            self.kept = {name: {} for name in names}
        collecting = gc.isenabled()
        gc.disable()  # millions of strings and no cycles
        self.vocabulary.restore()
        try:
            parts = [self._split(text) if text else [] for text in texts]
            words: set[str] = set()
            for found in parts:
                words.update(found)
            first = self.kept[names[0]]
            new = words.difference(first)
            if len(first) + len(new) > CACHE_WORDS:
                stay = set().union(*self.recent, words).intersection(first)
                self.kept = {name: {word: kept[word] for word in stay} for name, kept in self.kept.items()}
            self.recent.append(words)
            self._learn({word for word in new if word[0] != "\n"})
            joined = {}
            for name, kept in self.kept.items():
                between, get = _VIEWS[name][1], kept.__getitem__
                joined[name] = [between.join(map(get, found)) for found in parts]
            return joined
        finally:
            if collecting:
                gc.enable()


_loaded: dict[int, Encoder] = {}


def encoder_of(sent: tuple[str, dict]) -> Encoder:
    """One encoder per Python worker and vocabulary."""
    definition, tables = sent
    key = hash(definition)
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Encoder(Vocabulary(definition, tables))
    return _loaded[key]


def broadcast_vocabulary(df: DataFrame, tokenizer_path: str):
    """The vocabulary file's text and the library's tables, about 2 MB whatever the data, for every executor."""
    with open(tokenizer_path, encoding="utf-8") as file:
        return df.sparkSession.sparkContext.broadcast((file.read(), library_tables()))


def id_lists(packed: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0] + [len(p) // 4 for p in packed], dtype=np.int32)
    kind = pa.list_(pa.field("element", pa.int32(), nullable=False))
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(packed), np.int32)), type=kind)


def _digests(values: list[bytes]) -> pa.Array:
    return pa.array([hashlib.sha256(v).hexdigest() for v in values], pa.string())


#: Results of ``round_trip``: type, the view it is made of, and how.
RESULTS: dict[str, tuple[DataType, str, Callable[[list[bytes]], pa.Array]]] = {
    "ids": (ArrayType(IntegerType(), False), "packed", id_lists),
    "n_tokens": (LongType(), "decimal", lambda v: pa.array([x.count(b" ") + 1 if x else 0 for x in v], pa.int64())),
    "ids_sha256": (StringType(), "decimal", _digests),
    "decoded": (StringType(), "decoded", lambda v: pa.array(v, pa.binary()).cast(pa.string())),
    "decoded_sha256": (StringType(), "decoded", _digests),
}


def round_trip(df: DataFrame, tokenizer_path: str, results: Sequence[str], text: str = "text", keep_text: bool = False) -> DataFrame:
    """``df`` with the asked results of encoding and decoding every whole text, in one pass.

    ``ids``, ``n_tokens``, the SHA-256 of the decimal ids joined by spaces, the decoded text and its SHA-256.
    """
    definition = broadcast_vocabulary(df, tokenizer_path)
    schema = with_fields(df, [StructField(name, RESULTS[name][0], False) for name in results], drop=[] if keep_text else [text])
    needed = tuple(dict.fromkeys(RESULTS[name][1] for name in results))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(definition.value)
        for block in blocks(batches, text, BLOCK):
            views = encoder.views(block.column(text).to_pylist(), needed)
            yield assemble(block, schema, {name: RESULTS[name][2](views[RESULTS[name][1]]) for name in results})
        encoder.forget()

    return df.mapInArrow(run, schema)


def encode(df: DataFrame, tokenizer_path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` without its text, with ``ids``: the token ids of the whole text, empty for null."""
    definition = broadcast_vocabulary(df, tokenizer_path)
    schema = with_fields(df, [StructField(ids, ArrayType(IntegerType(), False), False)], drop=[text])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(definition.value)
        for block in blocks(batches, text, BLOCK):
            yield assemble(block, schema, {ids: id_lists(encoder.views(block.column(text).to_pylist())["packed"])})
        encoder.forget()

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, tokenizer_path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with ``decoded``: the tokens of ``ids`` joined by spaces, as a vocabulary without a decoder does."""
    definition = broadcast_vocabulary(df, tokenizer_path)
    schema = with_fields(df, [StructField(decoded, StringType(), False)])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spec = json.loads(definition.value[0])
        names = {i: t for t, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        table = np.array([names.get(i) for i in range(max(names) + 1)], dtype=object)
        for block in blocks(batches, ids):
            texts = []
            for value in block.column(ids):
                numbers = value.values.to_numpy(zero_copy_only=False) if value.is_valid else np.zeros(0, np.int32)
                inside = numbers[(numbers >= 0) & (numbers < len(table))]
                texts.append(" ".join(t for t in table[inside].tolist() if t is not None) if len(inside) else "")
            yield assemble(block, schema, {decoded: pa.array(texts, pa.string())})

    return df.mapInArrow(run, schema)
