from claimstrata.llm import token_counts


def test_characters_newer_than_the_library_are_no_letters_or_numbers_and_fold_as_there():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = str(public_tokenizers.path("word_bpe_49k.json"))
    library = Tokenizer.from_file(path)
    edges = [*map(chr, token_counts._LOWER)]
    edges += [chr(int(x, 16)) for part in token_counts._LATER.split() for x in part.split("-")]
    texts = [f"{before}{c}{after}" for c in edges for before, after in (("¨", ""), ("a", "b"), ("1", "é"), ("", c))]
    want = [len(x.ids) for x in library.encode_batch(texts, add_special_tokens=False)]
    assert token_counts.merger(path).count([x.encode() for x in texts]) == want
