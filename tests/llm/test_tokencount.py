"""Token counts against the library itself."""

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from snapfeed.llm import tokencount

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY, VOCAB = Tokenizer.from_file(PATH), tokencount.load(PATH)


def expected(texts):
    return [len(e.ids) for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]


def test_corpus(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    found = {r.key: (r.n_bytes, r.n_tokens) for r in tokencount.token_counts(docs, PATH).collect()}
    texts = [r.text for r in rows]
    assert found == {r.doc_id: (len(t.encode()), n) for r, t, n in zip(rows, texts, expected(texts), strict=True)}


def test_cases(docs):
    texts = ["", " ", "a" * 9000, "ab" * 5000, "<|endoftext|>", "x <|endoftext|> y<|endoftext|>", "<|endoftext", "\n\n \t\r\n", "I'll don't WE'VE 's",
             "日本語テキスト" * 50, "🙂🙃" * 99 + "\x00", "0123456789" * 200, "é" * 333, "".join(chr(97 + i * 7919 % 26) for i in range(20_000))]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "null key"), (3, "repeated key"), (100, None)]
    found = sorted(((r.key, r.n_bytes, r.n_tokens) for r in tokencount.token_counts(docs(rows), PATH).collect()), key=str)
    assert found == sorted(((k, len((t or "").encode()), n) for (k, t), n in zip(rows, expected([t or "" for _, t in rows]), strict=True)), key=str)
    assert tokencount.token_counts(docs([]), PATH).count() == 0


def test_pieces_of_long_texts(monkeypatch):
    """A long text is taken up in pieces, and the remembered counts are dropped, without any effect."""
    text = " ".join(f"word{i} don't  stop\n" for i in range(3000))
    monkeypatch.setattr(tokencount, "CHARS", 100)
    monkeypatch.setattr(tokencount, "TOKENS", 50)
    monkeypatch.setattr(tokencount, "REMEMBERED", 10)
    assert tokencount.count([text, "", text], VOCAB).tolist() == expected([text, "", text])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from("aab cd'\n 1é日🙂"), st.characters(codec="utf-8")), max_size=60), max_size=5))
def test_any_text(texts):
    assert tokencount.count(texts, VOCAB).tolist() == expected(texts)
