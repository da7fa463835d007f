"""Token ids with the ``tokenizers`` library, cached by unit of text.

``tokenize`` adds a binary column: the ids of each whole text as little-endian
unsigned 32-bit integers. Texts are cut into units that the tokenizer treats
independently, each distinct unit is encoded by the library and kept in a bounded
per-worker cache, and a text's ids are its units' ids in order.

Which cuts are safe depends on the tokenizer (``unit_rule``):

* ``gpt2`` (byte-level BPE with the usual pattern, no normalizer): matches
  hold white space only at their start, so a text may be cut before a single
  space or line feed that follows a non-space. A unit is safe if white space
  occurs in it at most as its first character; a text with any other unit is
  cut before whole white-space runs instead.
* ``space`` (white space only separates, case is dropped): a text may be cut
  before every space and line feed, and A-Z lower-cased beforehand.
* ``whole``: no cuts.

Cases: null text is the empty text (no ids); special-token strings inside a
text are ordinary text; a text holding U+0000 or U+001C-U+001F is encoded
whole.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release, ship_package

#: A worker's cache keeps two generations of units of this many characters.
CACHE_CHARS = 1 << 21
#: Bytes of text whose units are looked up together.
CHUNK_BYTES = 1 << 21
#: White space that is not the first of two or more characters of a unit, in
#: units joined by U+0000.
_INNER = re.compile(r"[^\x00]\s|\s(?=\x00|\Z)")
#: Characters that stand for the bytes that are not printable Latin-1 in the
#: byte-level alphabet: U+0100 upwards in byte order (rule of the format).
BYTE_CHARS = {b: 256 + i for i, b in enumerate(
    b for b in range(256) if not (0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b))}
#: Units that are one piece: Latin-1 letters, after a space with the rule
#: ``gpt2``, and with ``space`` only those that normalisation leaves as they are.
_WORD = {"gpt2": re.compile(r" [A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+"),
         "space": re.compile(r"[a-z\u00df-\u00f6\u00f8-\u00ff]+")}
#: A Latin-1 letter, a single full stop or comma, then a space or line feed: both
#: rules part the mark from the letters, so it becomes a unit of its own.
_STOP = "([A-Za-z\u00df-\u00f6\u00f8-\u00ff])([.,])([ \n])"
_RUNS = re.compile(r"\s*\S+|\s+\Z")
_ODD = r"[\x00\x1c-\x1f]"
_ODD_CHARS = re.compile(_ODD)


def unit_rule(path: str) -> str:
    """The safe unit rule of a tokenizer file, from its own description."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
    if norm is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space"):
        return "gpt2"
    first = (pre.get("pretokenizers") or [{}])[0]
    steps = {x.get("type") for x in (norm or {}).get("normalizers", [])}
    # pieces are the pattern's matches without white space; NFC, white-space
    # replacement and lower-casing act within a unit
    if (first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert")
            and "[^\\s" in first.get("pattern", {}).get("Regex", "") and "Lowercase" in steps
            and steps <= {"NFC", "Replace", "Lowercase"}):
        return "space"
    return "whole"


class UnitEncoder:
    """Ids of texts as bytes; one per Python worker and tokenizer file."""

    def __init__(self, path: str, rule: str):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        vocab = self.tok.get_vocab()
        #: Bytes of text each id stands for.
        self.width = np.zeros(max(vocab.values()) + 1, dtype=np.int64)
        for token, i in vocab.items():
            self.width[i] = len(token.removesuffix("</w>"))
        self.model = self.tok.model
        self.rule = rule
        self.units: dict[str, bytes] = {"": b""}   # current generation
        self.older: dict[str, bytes] = {}      # the one before; units in use move up
        self.chars = 0
        self.unsafe: set[str] = set()          # units that are not independent

    def whole(self, texts: list[str]) -> list[bytes]:
        got = self.tok.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(x.ids, dtype="<u4").tobytes() for x in got]

    def together(self, units: list[str]) -> list[bytes]:
        """Ids of units without inner white space, encoded as one text (with
        ``gpt2`` each begins with a space or line feed, with ``space`` none
        does). Every id stands for a known number of bytes, so the bytes of the
        units tell where their ids end."""
        text = "".join(units) if self.rule == "gpt2" else " ".join(units)
        if text.isascii():
            sizes = np.fromiter(map(len, units), np.int64, len(units))
        else:
            parts = units if self.rule == "gpt2" else self.tok.normalizer.normalize_str(text).split(" ")
            sizes = np.array([len(p.encode()) for p in parts])
        ids = np.array(self.tok.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")
        ends = np.cumsum(self.width[ids])
        want = np.cumsum(sizes)
        cuts = np.searchsorted(ends, want, side="right")
        if len(sizes) != len(units) or ends[-1] != want[-1] or (ends[cuts - 1] != want).any():
            return self.whole(units)
        raw = ids.tobytes()
        cuts = (4 * cuts).tolist()
        return [raw[i:j] for i, j in zip([0, *cuts], cuts)]

    def words(self, units: set[str]) -> set[str]:
        """Put units that are one piece straight through the tokenizer's model,
        in the byte-level alphabet, and return the rest."""
        rest, word, tokenize = set(), _WORD[self.rule].fullmatch, self.model.tokenize
        lead = "\u0120" if self.rule == "gpt2" else ""
        for u in units:
            if not word(u):
                rest.add(u)
                continue
            form = u if u.isascii() else u.encode().decode("latin-1").translate(BYTE_CHARS)
            if lead:
                form = lead + (form[1:])
            self.units[u] = array("I", [t.id for t in tokenize(form)]).tobytes()
        return rest

    def learn(self, missing: set[str]) -> None:
        """Put units into the current generation."""
        size = sum(map(len, missing))
        if self.chars and self.chars + size > CACHE_CHARS:
            self.older, self.units, self.chars = self.units, {"": b""}, 0
        self.chars += size
        if self.older:
            known = {w: self.older[w] for w in missing if w in self.older}
            self.units.update(known)
            missing = missing - known.keys()
        new = list(self.words(missing))
        if not new:
            return
        odd = {w for w in new if "<|" in w or self.rule == "gpt2" and w[:1] not in " \n"}
        if _INNER.search("\x00".join(new)):
            inner = {w for w in new if _INNER.search(w)}
            if self.rule == "gpt2":
                self.unsafe |= inner
                new = [w for w in new if w not in inner]
            odd |= inner
        alone = [w for w in new if w in odd or not w]
        self.units.update(zip(alone, self.whole(alone), strict=True))
        many = [w for w in new if w and w not in odd]
        plain = [w for w in many if w.isascii()]
        for group in (plain, [w for w in many if not w.isascii()]):
            for i in range(0, len(group), 4000):
                part = group[i:i + 4000]
                self.units.update(zip(part, self.together(part), strict=True))

    def runs(self, text: str) -> bytes:
        """A text with an unsafe unit: cut before whole white-space runs."""
        return b"".join(self.whole(_RUNS.findall(text)))

    def lookup(self, units: list[str]) -> list[bytes | None]:
        """Ids of distinct units; None for an unsafe one."""
        got = list(map(self.units.get, units))
        places = [i for i, x in enumerate(got) if x is None]
        if places:
            self.learn({units[i] for i in places} - self.unsafe)
            for i in places:
                got[i] = self.units.get(units[i])
        return got

    def chunk(self, texts: pa.Array) -> pa.Array:
        """Ids of some texts: split into units and numbered by Arrow, the ids
        of the distinct units are looked up and put in the units' places."""
        n = len(texts)
        odd = np.ones(n, dtype=bool) if self.rule == "whole" else \
            pc.match_substring_regex(texts, _ODD).to_numpy(zero_copy_only=False).astype(bool)
        usual = pc.if_else(pa.array(odd), "", texts) if odd.any() else texts
        if self.rule == "space":
            usual = pc.replace_substring(pc.ascii_lower(usual), "\n", " ")
            parts = pc.split_pattern(pc.replace_substring_regex(usual, _STOP, r"\1 \2\3"), " ")
        else:
            usual = pc.replace_substring_regex(usual, _STOP, "\\1\x00\\2\\3")
            usual = pc.replace_substring(usual, " ", "\x00 ")
            parts = pc.split_pattern(pc.replace_substring(usual, "\n", "\x00\n"), "\x00")
        numbered = parts.flatten().dictionary_encode()
        ids = self.lookup(numbered.dictionary.to_numpy(zero_copy_only=False).tolist())
        ends = parts.offsets.to_numpy()
        unsafe = np.array([x is None for x in ids], dtype=bool)
        if unsafe.any():
            at = np.nonzero(unsafe[numbered.indices.to_numpy()])[0]
            odd[np.searchsorted(ends, at + ends[0], side="right") - 1] = True
        flat = pa.array([x or b"" for x in ids], pa.binary()).take(numbered.indices)
        places = np.frombuffer(flat.buffers()[1], dtype=np.int32, count=len(flat) + 1)
        out = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(places[ends - ends[0]].tobytes()),
                                                     flat.buffers()[2]])
        if odd.any():
            got = out.to_pylist()
            for i in np.nonzero(odd)[0]:
                text = texts[int(i)].as_py()
                whole = self.rule != "gpt2" or _ODD_CHARS.search(text)
                got[i] = self.whole([text])[0] if whole else self.runs(text)
            out = pa.array(got, pa.binary())
        return out

    def encode(self, texts: pa.Array) -> pa.Array:
        """Ids (binary) of an array of texts, in pieces of bounded size."""
        if not len(texts):
            return pa.array([], pa.binary())
        texts = texts.fill_null("")
        size = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        piece = size // CHUNK_BYTES
        cuts = [0, *(np.nonzero(np.diff(piece))[0] + 1).tolist(), len(texts)]
        return pa.concat_arrays([self.chunk(texts.slice(i, j - i)) for i, j in zip(cuts, cuts[1:])])


@lru_cache(maxsize=4)
def encoder(path: str, rule: str) -> UnitEncoder:
    return UnitEncoder(path, rule)


def tokenize(df: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``df`` with ``out`` (binary): each text's ids, 4 bytes an id."""
    ship_package(df.sparkSession)
    rule = unit_rule(path)

    @F.arrow_udf("binary")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        enc = encoder(path, rule)
        for batch in batches:
            yield enc.encode(batch)
            release()

    return df.withColumn(out, ids(F.col(text)))
