"""Token counts of whole texts with a public tokenizer.

Encoding runs in an Arrow function that returns lengths only.  Each Arrow
batch is cut into slices of about equal bytes (not rows), so one slice of long
texts costs what one slice of short texts does.  Texts are split at white
space, which the vocabulary's pre-tokenizer never crosses, so the sum over the
parts is the count of the whole text.  Equal parts within a slice are encoded
once, and each call of the encoder gets a bounded number of characters.

A part of more than ``LONG_CHARS`` characters (text without white space) is cut
further, at places that change no token: where the pre-tokenizer ends a word
(between letters, digits and other signs), and inside a run of letters between
two bytes that no merge of the vocabulary joins; pieces that end there are
encoded without the mark of a word's end.  Characters that normalisation may
join or rewrite are never beside a cut.  A run of letters in which every pair of
neighbours occurs in a merge goes to the encoder whole.

Nulls and empty texts count 0 tokens and 0 bytes.  Extra input columns are
ignored; repeated rows give repeated results; an empty table gives no rows.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lading.session import ship_package

#: Bytes of text encoded at once in a task.
SLICE_BYTES = 16 << 20
#: Parts whose counts a Python worker keeps between slices.
MEMO_ENTRIES = 400_000
#: Longer parts are not kept in the memo.
MEMO_CHARS = 40
#: Parts, and their characters, given to the encoder in one call.
ENCODE_PARTS = 20_000
ENCODE_CHARS = 1 << 19
#: Longer parts are cut further.
LONG_CHARS = 1 << 15
#: The pre-tokenizer whose word ends are known here (fixed value).
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_TOKENIZERS: dict[str, object] = {}
_MEMO: dict[str, dict[str, int]] = {}


def vocabulary_path(name: str) -> str:
    """Place of a public vocabulary file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _tokenizer(vocabulary: str):
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one core a task
    if vocabulary not in _TOKENIZERS:
        from tokenizers import Tokenizer

        _TOKENIZERS[vocabulary] = Tokenizer.from_file(vocabulary_path(vocabulary))
    return _TOKENIZERS[vocabulary]


class Cuts:
    """Places where a long text without white space can be cut."""

    def __init__(self, vocabulary: str):
        import json

        from tokenizers import Tokenizer

        with open(vocabulary_path(vocabulary), encoding="utf-8") as f:
            spec = json.load(f)
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        model = spec["model"]
        self.known = steps[0].get("pattern") == {"Regex": WORDS} and model["type"] == "BPE"
        if not self.known:
            return
        suffix = model["end_of_word_suffix"] or ""
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.joined = {(a[-1], b.removesuffix(suffix)[0]) for a, b in pairs}
        self.tokenizer = Tokenizer.from_str(json.dumps({**spec, "model": {**model, "end_of_word_suffix": None}}))
        # The vocabulary writes a byte as itself if printable, else from U+0100 on.
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in shown]
        self.sign = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(rest)}
        # Second characters of canonical compositions.
        forms = (unicodedata.decomposition(chr(c)).split() for c in range(0x110000))
        self.seconds = {chr(int(f[1], 16)) for f in forms if len(f) == 2 and f[0][0] != "<"}
        self.seconds.update(map(chr, range(0x1160, 0x1200)))  # vowels and finals of Hangul
        self._kinds: dict[str, str] = {}

    def kind(self, c: str) -> str:
        """L, N or S (other signs); empty for what normalisation may change or
        Unicode versions see differently."""
        got = self._kinds.get(c)
        if got is None:
            low, cat = c.lower(), unicodedata.category(c)
            plain = (cat == unicodedata.ucd_3_2_0.category(c) and cat[0] in "LNPS" and len(low) == 1
                     and unicodedata.category(low)[0] == cat[0] and not unicodedata.combining(c)
                     and c not in self.seconds and low not in self.seconds
                     and unicodedata.normalize("NFC", c) == c and unicodedata.normalize("NFC", low) == low)
            got = self._kinds[c] = ("" if not plain else cat[0] if cat[0] in "LN" else "S")
        return got

    def word_end(self, a: str, b: str) -> bool:
        """Whether a word ends between these two characters."""
        if a in "'|" or b == "|":  # contractions; special strings
            return False
        ka, kb = self.kind(a), self.kind(b)
        return bool(ka and kb) and (ka != kb or ka == "N")

    def apart(self, a: str, b: str) -> bool:
        """Whether these neighbouring letters never meet in a token."""
        return (self.kind(a) == self.kind(b) == "L"
                and (self.sign[a.lower().encode()[-1]], self.sign[b.lower().encode()[0]]) not in self.joined)

    def pieces(self, text: str) -> Iterator[tuple[str, bool]]:
        """The text in pieces, and whether a piece ends at the end of a word."""
        at, reach = 0, LONG_CHARS
        while len(text) - at > reach:
            for k in range(at + reach, at + reach - LONG_CHARS, -1):
                if self.word_end(text[k - 1], text[k]):
                    yield text[at:k], True
                    at, reach = k, LONG_CHARS
                    break
            else:
                inner = text[at: at + reach]
                k = 0
                if all(self.kind(c) == "L" for c in set(inner)):
                    k = next((k for k in range(at + reach, at + reach - LONG_CHARS, -1) if self.apart(text[k - 1], text[k])), 0)
                if k:
                    yield text[at:k], False
                    at, reach = k, LONG_CHARS
                else:
                    reach += LONG_CHARS
        yield text[at:], True


_CUTS: dict[str, Cuts] = {}


def _count_long(part: str, vocabulary: str) -> int:
    if vocabulary not in _CUTS:
        _CUTS[vocabulary] = Cuts(vocabulary)
    cuts, tok = _CUTS[vocabulary], _tokenizer(vocabulary)
    if not cuts.known:
        return len(tok.encode(part, add_special_tokens=False))
    return sum(len((tok if whole else cuts.tokenizer).encode(p, add_special_tokens=False)) for p, whole in cuts.pieces(part))


def _calls(parts: list[str], some: list[int]) -> Iterator[list[int]]:
    """The parts numbered ``some`` in calls of bounded size."""
    call, chars = [], 0
    for i in some:
        if call and (len(call) == ENCODE_PARTS or chars + len(parts[i]) > ENCODE_CHARS):
            yield call
            call, chars = [], 0
        call.append(i)
        chars += len(parts[i])
    if call:
        yield call


def _count_parts(parts: list[str], vocabulary: str) -> list[int]:
    """Tokens of each part, through the worker's memo."""
    memo = _MEMO.setdefault(vocabulary, {})
    counts = [memo.get(p, -1) for p in parts]
    missing = [i for i, c in enumerate(counts) if c < 0]
    if not missing:
        return counts
    tok = _tokenizer(vocabulary)
    for i in missing:
        if len(parts[i]) > LONG_CHARS:
            counts[i] = _count_long(parts[i], vocabulary)
    for some in _calls(parts, [i for i in missing if counts[i] < 0]):
        for i, enc in zip(some, tok.encode_batch_fast([parts[i] for i in some], add_special_tokens=False), strict=True):
            counts[i] = len(enc)
    if len(memo) + len(missing) > MEMO_ENTRIES:
        memo.clear()
    for i in missing[:MEMO_ENTRIES]:
        if len(parts[i]) <= MEMO_CHARS:
            memo[parts[i]] = counts[i]
    return counts


def count_column(texts: pa.Array, vocabulary: str):
    """Token counts (int64 array) of a column of texts."""
    import numpy as np
    import pyarrow.compute as pc

    texts = texts.fill_null("")
    lengths = np.asarray(pc.binary_length(texts), np.int64)
    cum = np.concatenate([[0], np.cumsum(lengths)])
    out = np.zeros(len(texts), np.int64)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(cum, cum[i] + SLICE_BYTES, "right")) - 1)
        parts = pc.split_pattern_regex(texts.slice(i, j - i), r"[\t-\r ]+")
        offsets = np.asarray(parts.offsets, np.int64)
        coded = parts.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
        per_part = np.asarray(_count_parts(coded.dictionary.to_pylist(), vocabulary), np.int64)
        total = np.concatenate([[0], np.cumsum(per_part[np.asarray(coded.indices)])]) if len(coded) else np.zeros(1, np.int64)
        out[i:j] = np.diff(total[offsets - offsets[0]])
        i = j
    return out


def count_tokens(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                 vocabulary: str = "word_bpe_49k.json", limit: int = 2048) -> DataFrame:
    """One row per input row: the id, n_bytes (UTF-8), n_tokens, over_limit.

    ``vocabulary`` names a ``tokenizers`` file whose pre-tokenizer drops white
    space, so that white space is a safe place to split.  Special strings inside
    texts are handled as the library's default; nothing is added, truncated or
    padded.
    """
    ship_package(docs.sparkSession)

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        for b in batches:
            texts = b.column(1).fill_null("")
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pc.binary_length(texts).cast(pa.int64()), pa.array(count_column(texts, vocabulary))],
                names=["id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(lengths, f"id {kind}, n_bytes long, n_tokens long")
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
