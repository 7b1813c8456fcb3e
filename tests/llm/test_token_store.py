"""Token ids of texts that hold the strings the word cache or the tokenizer itself uses."""

from offerlens.llm import queries, token_store


def _plain(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    return [list(tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]


def _ours(texts, **options):
    return [list(memoryview(b).cast("i")) for b in token_store.encode(texts, queries.tokenizer_path(), **options)]


def test_words_that_begin_with_the_mark():
    texts = ["x \x01b", "b", "x\nb c", "x \x01b", "\x01", "x \x01 y", "x \x01", "a\n\x01b \x01\n c", "x \x01\x01b. d"]
    assert _ours(texts) == _plain(texts)
    assert [_ours([t])[0] for t in texts] == _plain(texts)


SPECIAL = ["x <|endoftext|> a", "<|endoftext|>", "a<|endoftext|><|endoftext|>b. c", "<|endoftext|", "plain text", "\x01<|endoftext|>\n d", ""]


def test_strings_of_special_tokens():
    assert _ours(SPECIAL, special_as_text=False) == _plain(SPECIAL) and 50256 in _plain(SPECIAL)[0]
    assert 50256 not in sum(_ours(SPECIAL), [])


def test_written_tokens_equal_the_library_default(spark, tmp_path):
    docs = spark.createDataFrame(list(enumerate(SPECIAL)), "doc_id long, text string")
    token_store.write_tokens(docs, f"{tmp_path}/tokens", queries.tokenizer_path())
    rows = token_store.read_tokens(spark, f"{tmp_path}/tokens").orderBy("doc_id").collect()
    want = [ids + [token_store.END] for ids in _plain(SPECIAL)]
    assert [list(r["ids"]) for r in rows] == want
    assert [r["start"] for r in rows] == [sum(map(len, want[:k])) for k in range(len(want))]


def test_words_of_one_hash_keep_their_own_ids(monkeypatch):
    """Hashes only point to a remembered word, the strings decide."""
    monkeypatch.setattr(token_store, "_hashes", lambda words: token_store.np.zeros(len(words), token_store.U))
    for texts in (["alpha beta gamma\ndelta. alpha", "beta"], ["gamma epsilon alpha", "zeta\nbeta"]) * 2:
        assert _ours(texts) == _plain(texts)
    state = token_store._tokenizer(queries.tokenizer_path())
    token_store._forget(state)
    assert (state["hash"][:-1] <= state["hash"][1:]).all() and sorted(state["whose"].tolist()) == list(range(len(state["words"])))


def test_known_words_take_no_second_encoding_and_bare_ones_share_a_call(monkeypatch):
    """Punctuation that ends a word is a part of its own, and words that begin lines are encoded in a row."""
    spaced, calls = [], []
    of_words, ids = token_store._ids_of_words, token_store._ids
    monkeypatch.setattr(token_store, "_ids_of_words", lambda tokenizer, blank, words: spaced.extend(words) or of_words(tokenizer, blank, words))
    monkeypatch.setattr(token_store, "_ids", lambda tokenizer, texts: calls.append(len(texts)) or ids(tokenizer, texts))
    texts = ["\n".join(f"begin{i}x$$$ tail{i}y!? don't" for i in range(50)), "q tail1y). tail2y's\nbegin3x\t$ (tail3y)"]
    assert _ours(texts) == _plain(texts)
    assert "tail1y" in spaced and not any(w.endswith(("!?", ").", "$$$")) for w in spaced) and max(calls) <= 2


def test_words_met_again_are_encoded_once_and_the_rest_forgotten(monkeypatch):
    """Ids come in one array; a full stop or comma after a letter is not part of the word that is encoded."""
    monkeypatch.setattr(token_store, "CACHED", 8)
    state = token_store._tokenizer(queries.tokenizer_path())
    monkeypatch.setitem(state, "met", state["met"] & False)
    token_store._forget(state)
    asked = []
    encode = token_store._ids_of_words
    monkeypatch.setattr(token_store, "_ids_of_words", lambda tokenizer, blank, words: asked.extend(words) or encode(tokenizer, blank, words))
    for texts in (["q zorgle zorgle. zorgle,", "", "²."], ["q zorgle. x7. \n"] + [f"q other{i}x, zorgle" for i in range(9)], ["q zorgle é. other1x"] * 3, SPECIAL):
        values, limit = token_store.encoded(texts, queries.tokenizer_path(), special_as_text=False)
        assert [values[a:b].tolist() for a, b in zip(limit, limit[1:])] == _plain(texts)
    assert asked.count("zorgle") == 1 and "zorgle." not in asked and asked.count("other1x") == 2
    assert token_store.encoded([], queries.tokenizer_path())[1].tolist() == [0]
