"""SentencePiece ids and spans against the library, also with character maps grafted onto the model."""

import hashlib
import random

import pytest
import sentencepiece

from agora.llm import piece_spans, queries

LETTERS = list("ab the  \t\n.é1h") + ["́", "ﬁ", "①", "　", "\xa0", "日", "😀", "▁", "½", "Å", "¨", "\x00", "㌔", "ﷺ", "​", "\xad"]


def model_bytes():
    with open(queries.pieces_path(), "rb") as file:
        return file.read()


def grafted(rule, dummy, squeeze):
    """The model with the named normaliser's compiled map and other rules for spaces."""
    normalizer = sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto()
    spec = next(v for k, v, _ in piece_spans._fields(normalizer) if k == 3)
    compiled = next(v for k, v, _ in piece_spans._fields(spec) if k == 2)
    number = piece_spans._varint
    own = number(2 << 3 | 2) + number(len(compiled)) + compiled + number(3 << 3) + bytes([dummy]) + number(4 << 3) + bytes([squeeze])
    return piece_spans.with_normalizer(model_bytes(), own)


def same_as_library(proto, texts, **settings):
    model = piece_spans.Model(proto, **settings)
    for text, (ids, starts, ends) in zip(texts, model.encode(texts), strict=True):
        wanted = [(p.id, p.begin, p.end) for p in model.whole.encode(text, return_type="proto").pieces]
        assert list(zip(ids.tolist(), starts.tolist(), ends.tolist())) == wanted, text


def fuzz(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choices(LETTERS, k=rng.randint(0, 20))) for _ in range(n)]


def test_ids_and_spans_of_the_model():
    texts = fuzz(3000) + ["", " ", "a", "the cat " * 3000, "x" * 5000, "\n" * 40, "a\nb é\tc", "word " * 200]
    same_as_library(model_bytes(), texts)
    same_as_library(model_bytes(), texts[-400:], remembered=5)


@pytest.mark.parametrize("rule", ["nfkc", "nmt_nfkc_cf"])
@pytest.mark.parametrize("dummy", [0, 1])
@pytest.mark.parametrize("squeeze", [0, 1])
def test_longest_keys_of_a_compiled_map(rule, dummy, squeeze):
    same_as_library(grafted(rule, dummy, squeeze), [*fuzz(800, 2), " ", "  ", "▁", " ▁ ", "▁▁ "])


def test_longest_key_wins():
    model = piece_spans.Model(grafted("nfkc", 1, 0))
    assert model.normalise("é ﬁ").data.tobytes().decode() == "▁é▁fi"
    assert model.normalise("éx").source.tolist() == [0, 0, 0, 0, 0, 3, 4]


def test_rows(docs, spark):
    texts = [None, "", " ", "a  b", "The cat.", "é😀\n", "x" * 40_000, "the cat " * 20_000, "The cat."]
    rows = [*enumerate(texts), (None, "no id"), (4, "The cat.")]
    frame = docs(rows).withColumnRenamed("n_chars", "ids")  # clashes with a result
    found = piece_spans.encode_spans(frame, queries.pieces_path(), keep=("text", "ids")).collect()
    whole = sentencepiece.SentencePieceProcessor(model_file=queries.pieces_path())
    assert len(found) == len(rows)
    for row in found:
        text = row["kept_text"] or ""
        assert row["ids"] == whole.encode(text) and row["decoded"] == whole.decode(whole.encode(text))
        assert row["kept_ids"] == len(text) and row["starts"][1:] == row["ends"][:-1]
        if text:
            assert (row["starts"][0], row["ends"][-1]) == (0, len(text.encode()))
    assert piece_spans.encode_spans(docs([]), queries.pieces_path()).count() == 0


def test_the_query_keeps_its_contract(spark):
    sf_dir = "/root/testdata/sf0.001"
    whole = sentencepiece.SentencePieceProcessor(model_file=queries.pieces_path())
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    wanted = []
    for row in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect():
        ids = whole.encode(row["text"] or "")
        wanted.append((row["doc_id"], len(ids), sha(",".join(map(str, ids))), sha(whole.decode(ids)), len((row["text"] or "").encode())))
    found = queries.op11_piece_spans(spark, sf_dir)
    assert sorted(map(tuple, found.collect())) == sorted(wanted)
    assert dict(found.dtypes)["n_tokens"] == "bigint"
