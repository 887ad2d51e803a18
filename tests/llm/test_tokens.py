import base64
import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

regex = pytest.importorskip("regex")
tiktoken = pytest.importorskip("tiktoken")
from ledgerloom.llm import tokens as T  # noqa: E402

PATH = f"{T.FOLDER}/byte_bpe_50k.tiktoken"
pytestmark = pytest.mark.skipif(not os.path.exists(PATH), reason="no vocabulary here")


@pytest.fixture(scope="module")
def both():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return T.Vocabulary.read(PATH), tiktoken.Encoding("own", pat_str=T.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encode(v, texts):
    return [list(x) for x in T.encode_batch(texts, v, {}, regex.compile(T.PATTERN).findall)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=60) | st.text("aăș \n\t1.'lls<|>", max_size=80), max_size=12))
def test_equals_the_library(both, texts):
    v, library = both
    assert encode(v, texts) == [library.encode_ordinary(t) for t in texts]


@pytest.mark.parametrize("text", ["a" * 4000, "ab" * 2500, " " * 3001, "\n" * 1500, "ș" * 900, "<|endoftext|> x", "0" * 3000, "x" * 600 + " y" * 600])
def test_long_words(both, text):
    v, library = both
    assert encode(v, [text]) == [library.encode_ordinary(text)]


def test_documents(spark, both):
    df = spark.createDataFrame([(1, "Sold ștampilă", "x"), (2, "", "x"), (3, None, "x"), (4, "  ", "x"), (1, "Sold ștampilă", "x"), (None, "a", "x")], "doc_id long, text string, ids string")
    got = {(r.doc_id, tuple(r.ids)) for r in T.encode_documents(df).collect()}
    library = both[1]
    assert got == {(1, tuple(library.encode_ordinary("Sold ștampilă"))), (2, ()), (3, ()), (4, tuple(library.encode_ordinary("  "))), (None, tuple(library.encode_ordinary("a")))}
    assert T.encode_documents(df.limit(0)).count() == 0 and dict(T.encode_documents(df).dtypes)["ids"] == "array<int>"
