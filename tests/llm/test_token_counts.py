from tokenizers import Tokenizer

from lading.llm import token_counts as T
from tests_llm_texts import TEXTS


def test_counts_are_the_librarys(spark):
    tok = Tokenizer.from_file(T.vocabulary_path("word_bpe_49k.json"))
    rows = [(k, t) for k, t in enumerate(TEXTS)] + [(None, "no id"), (0, "again"), (0, "again")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, n_tokens string")
    got = sorted((tuple(r) for r in T.count_tokens(docs).collect()), key=str)
    want = []
    for i, t in rows:
        n = len(tok.encode(t or "", add_special_tokens=False).ids)
        want.append((i, len((t or "").encode()), n, n > 2048))
    assert got == sorted(want, key=str)


def test_slices_do_not_change_counts(monkeypatch):
    import pyarrow as pa

    texts = pa.array([t for t in TEXTS] * 2)
    whole = T.count_column(texts, "word_bpe_49k.json").tolist()
    monkeypatch.setattr(T, "SLICE_BYTES", 50)
    monkeypatch.setattr(T, "MEMO_ENTRIES", 3)
    assert T.count_column(texts, "word_bpe_49k.json").tolist() == whole


def _unspaced(seed, n):
    """Texts without white space, with what normalisation and cuts must respect."""
    import random

    r = random.Random(seed)
    kinds = [
        lambda: chr(r.randrange(0x4E00, 0x9FA5)),
        lambda: r.choice("。，、！？「」"),
        lambda: r.choice("abcdefghijklmnopqrstuvwxyzABCQXZ"),
        lambda: r.choice("e\u0301 a\u0308 o\u0327\u0301 I\u0307 \u0130 \u03a3 \u1100\u1161\u11a8 \uac00\u11a8 \u212b \u0958".split()),
        lambda: r.choice("0123456789\u0663\u00bd"),
        lambda: r.choice(["'s", "'re", "'", "''t", "<|endoftext|>", "<|startoftext|>", "<|", "|>", "!!", "\u3000", "\u00a0", "\U0001f600", "\u200d"]),
        lambda: chr(r.randrange(0xAC00, 0xD7A3)),
        lambda: chr(r.randrange(0x3041, 0x3096)),
    ]
    return "".join(r.choice(kinds[: 1 + seed % len(kinds)])() if r.random() < 0.7 else kinds[seed % len(kinds)]() for _ in range(n))


def test_unspaced_texts_are_cut_without_changing_counts(monkeypatch):
    import pyarrow as pa

    tok = Tokenizer.from_file(T.vocabulary_path("word_bpe_49k.json"))
    monkeypatch.setattr(T, "LONG_CHARS", 12)
    texts = [_unspaced(k, 400) for k in range(160)] + ["a" * 500, "qjqj" * 200, "acgt" * 100, "x'" * 60, "1" * 90, "\u0301" * 50]
    want = [len(tok.encode(t, add_special_tokens=False)) for t in texts]
    assert T.count_column(pa.array(texts), "word_bpe_49k.json").tolist() == want
    cuts = T.Cuts("word_bpe_49k.json")
    assert all("".join(p for p, _ in cuts.pieces(t)) == t for t in texts)
    assert any(not whole for t in texts for _, whole in cuts.pieces(t))


def test_a_long_unspaced_text_is_never_one_piece():
    cuts = T.Cuts("word_bpe_49k.json")
    for text in (_unspaced(0, 300_000), "https://x.org/" + "a1B2-" * 60_000, _unspaced(6, 200_000)):
        assert max(len(p) for p, _ in cuts.pieces(text)) <= 2 * T.LONG_CHARS


def test_empty_table(spark):
    assert T.count_tokens(spark.createDataFrame([], "doc_id long, text string")).collect() == []
