import public_tokenizers
import pytest
from tokenizers import Tokenizer

from reviewlens.llm import tokens

from .util import clashing, frame, prose

JSON = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    None, "", " ", "\n", "a\n\nb", "a  b", "  a", "a  ", "x \n y\t\tz", "a b  c", "　", "don't we'll I'M", "<|endoftext|>",
    "a<|endoftext|> b", "été où ß", "漢字 かな", "a\r\nb", "\x1c a", "a \x85 b", "1234 5.6", "x" * 3000, "  \n  \n", "é  z",
    "!!! ***", " ​ a", "\x0b\x0c q", "emoji 🙂 🙂🙂", "tab\tword", "a\n b\n  c",
]


def library(texts):
    t = Tokenizer.from_file(JSON)
    return [len(t.encode(x or "", add_special_tokens=False).ids) for x in texts]


def test_counts_of_pieces_equal_the_library(spark):
    texts = [t for t in ODD if t is not None] + [prose(i, 200) for i in range(30)]
    texts += [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    with open(JSON, "rb") as f:
        assert tokens.counter(JSON, f.read())(texts) == library(texts)


def test_operator_and_cache(spark, tmp_path):
    rows = list(enumerate(ODD)) + [(100, "a  b"), (None, "a  b"), (100, "a  b"), (101, "word " * 60_000), (102, "late one")]
    want = sorted((str(i), len((t or "").encode()), n, n > 512) for (i, t), n in zip(rows, library([t for _, t in rows]), strict=True))
    cache = str(tmp_path / "cache")
    plain = lambda df: sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in df.collect())
    assert plain(tokens.count_tokens(clashing(frame(spark, rows)), JSON, cache)) == want
    stored = [r.content for r in tokens.read_cache(spark, cache).collect()]
    assert len(stored) == len(set(stored)) == len({t or "" for _, t in rows})
    # a stored count is used and not computed again
    more = frame(spark, [*rows, (103, "one more text")])
    tokens.count_tokens(more, JSON, cache).collect()
    assert tokens.read_cache(spark, cache).count() == len(stored) + 1
    assert tokens.count_tokens(frame(spark, []), JSON, cache).collect() == []


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_libraries(spark, tmp_path, name):
    path = public_tokenizers.path(name)
    got = {r.doc_id: r.n_tokens for r in tokens.count_tokens(frame(spark, [(1, "Some words here"), (2, None)]), path, str(tmp_path / "c")).collect()}
    assert got[1] > 2 and got[2] == 0
