"""Texts that are hard on tokenizers and word splitters."""

TEXTS = [
    None, "", " ", "Hello   World", "don't we'll I'd", "á e ́x", "x<|startoftext|>y <|endoftext|>", "\t\n\x0b\x0c\r mixed   spaces   wide",
    "ÀÉÎ ñandú straße 漢字 かな 😀😀", "1234567890 3.14 1,000", "!!!***### $$$a%%%", "word " * 3000, "unbroken" * 2000, "it 's ' s", "İstanbul ǅ ﬁ", "\u0000\u0001", "​ line ",
    "'s 't 're", "<|startoftext|", "a<|endoftext|>'s b",
]
