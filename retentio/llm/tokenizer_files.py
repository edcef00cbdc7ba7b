"""Where the public tokenizer files are; the operators take a path."""

from __future__ import annotations


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)
