"""Texts that hold an added token's string, against the library called with its defaults."""

from tokenizers import Tokenizer

from lexloom.llm import tokens

TEXTS = ["a <|endoftext|> b", "plain words, and a full stop.", "x<|endoftext|><|endoftext|>\n  y, z.", "<|endoftext|>", "<|endoftext |> <|end", ""]


def test_added_tokens_as_the_library():
    library = Tokenizer.from_file(tokens.default_path())
    ids, at = tokens.Encoder(tokens.default_path()).encode(TEXTS)
    for i, want in enumerate(library.encode_batch(TEXTS, add_special_tokens=False)):
        assert ids[at[i]:at[i + 1]].tolist() == [*want.ids, tokens.END]
    assert ids[:4].tolist() == [64, 220, 50256, 275]
