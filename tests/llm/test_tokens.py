"""Encoding, grammar shards and flat token files: exact round trips."""

import random
import zlib

import numpy as np
import pytest

from agora.llm import grammar_tokens, separator_scan
from agora.llm.encoding import Encoder
from agora.llm.queries import tokenizer_path

TEXTS = [None, "", " ", "a  b", " a", "a ", "a\nb", "a\n\nb c", "it's, a's.\nx", "<|endoftext|> x", "é,\nñ. ü", "x" * 30_000, "the cat " * 5_000]


@pytest.fixture(scope="module")
def encoder():
    return Encoder(tokenizer_path())


def test_chunks_encode_like_whole_texts(encoder):
    rng = random.Random(3)
    texts = ["".join(rng.choices("ab,. \n'sé1\t#<", k=rng.randint(0, 25))) for _ in range(3000)] + TEXTS
    for text, ids in zip(texts, encoder.encode(texts)):
        whole = encoder.tokenizer.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(ids, np.uint32).tolist() == whole


def test_forgetting_chunks_changes_nothing():
    small, large = Encoder(tokenizer_path(), cached=3), Encoder(tokenizer_path())
    texts = [f"word{i} of many words {i}" for i in range(600)]
    assert small.encode(texts) == large.encode(texts)


@pytest.mark.parametrize("n,kinds", [(0, 3), (1, 3), (300, 1), (1000, 2), (5000, 40)])
def test_grammar_round_trip(n, kinds):
    ids = np.random.default_rng(n).integers(0, kinds, n).astype(np.uint32)
    symbols, rules, lengths = grammar_tokens.compress(ids, 100, 4)
    grammar = grammar_tokens.Grammar(100, rules.ravel(), lengths)
    assert grammar.expand(symbols).tolist() == ids.tolist()
    for a, b in ((0, n), (n // 3, n // 2), (n // 2, n // 2)):
        assert grammar_tokens.decode_range(grammar, symbols, a, b).tolist() == ids[a:b].tolist()
    if n >= 1000:
        assert len(symbols) + 2 * len(rules) < n


def test_shards_hold_all_ids_in_order(docs, spark, fresh_path, encoder):
    rows = [(i * 7 % 101, TEXTS[i % len(TEXTS)]) for i in range(60)] + [(None, "no id"), (3, "again"), (3, "again")]
    folder = fresh_path()
    grammar_tokens.write_shards(docs(rows), tokenizer_path(), folder, shard_tokens=5000)
    found = grammar_tokens.read_documents(spark, folder).orderBy("start").collect()
    assert len(found) == len(rows)
    order = [r["doc_id"] for r in found]
    assert order == sorted(order, key=lambda x: (x is not None, x or 0))
    start = 0
    wanted = sorted((i is not None, i or 0, zlib.crc32(e + b"\x02\0\0\0"), len(e) // 4 + 1) for (i, _), e in zip(rows, encoder.encode([t for _, t in rows])))
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["ids_crc32"], r["n_tokens"]) for r in found) == wanted
    for row in found:
        assert row["start"] == start
        start += row["n_tokens"]


@pytest.mark.parametrize("block", [7, 1000])
def test_counts_are_stitched_over_blocks(docs, spark, fresh_path, block):
    rows = [(i, t) for i, t in enumerate([t if t is None else t[:3000] for t in TEXTS])] + [(None, "x y"), (2, " ")]
    folder = fresh_path()
    separator_scan.write_files(docs(rows).repartition(3), tokenizer_path(), folder, block_tokens=block)
    found = separator_scan.count_tokens(spark, folder).collect()
    plain = Encoder(tokenizer_path(), literal_specials=True)
    wanted = [(i, len(e) // 4) for (i, _), e in zip(rows, plain.encode([t for _, t in rows]))]
    assert sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"]) for r in found)) == sorted((i is None, i or 0, n) for i, n in wanted)
    assert not any(r["open"] for r in found)


def test_empty_tables_have_no_tokens(docs, spark, fresh_path):
    one, two = fresh_path(), fresh_path()
    grammar_tokens.write_shards(docs([]), tokenizer_path(), one)
    separator_scan.write_files(docs([]), tokenizer_path(), two)
    assert grammar_tokens.read_documents(spark, one).count() == 0
    assert separator_scan.count_tokens(spark, two).count() == 0


def test_an_ordinary_token_ends_no_document(docs, spark, fresh_path):
    with pytest.raises(Exception, match="ordinary token"):
        separator_scan.write_files(docs([(1, "a")]), tokenizer_path(), fresh_path(), end_id=2)


def test_a_range_is_read_without_laying_out_the_grammar():
    rng = np.random.default_rng(8)
    ids = np.tile(rng.integers(0, 50, 400), 60).astype(np.uint32)
    symbols, rules, lengths = grammar_tokens.compress(ids, 100, 4)
    grammar = grammar_tokens.Grammar(100, rules.ravel(), lengths)
    touched, plain = [], grammar.lengths
    grammar.lengths = lambda x: touched.append(len(x)) or plain(x)
    for a, b in ((0, 1), (777, 800), (23_990, 24_000), (5, 5), (24_000, 24_010), (0, 24_000)):
        touched.clear()
        assert grammar_tokens.decode_range(grammar, symbols, a, b).tolist() == ids[a:b].tolist()
        assert grammar.flat is None
        if b - a < 30:
            assert sum(touched[1:]) <= 40 * (b - a + 2)
    assert max(lengths) > 100


def test_no_pair_that_pays_is_left():
    rng = np.random.default_rng(3)
    ids = rng.integers(0, 60, 6000).astype(np.uint32)
    symbols, rules, lengths = grammar_tokens.compress(ids, 100)
    counts, last = {}, None
    for pair in zip(symbols[:-1].tolist(), symbols[1:].tolist()):
        if pair != last:  # of equal symbols in a row every other pair counts
            counts[pair] = counts.get(pair, 0) + 1
        last = pair if pair != last else None
    assert max(counts.values()) < 3 and len(rules) == len(lengths)
    assert grammar_tokens.Grammar(100, rules.ravel(), lengths).expand(symbols).tolist() == ids.tolist()


def test_whole_shards_are_read_without_taking_symbols_apart(monkeypatch):
    import pyarrow as pa

    ids = np.random.default_rng(1).integers(0, 5, 4000).astype(np.uint32)
    symbols, rules, lengths = grammar_tokens.compress(ids, 100)
    row = {
        "part": 0, "shard": 0, "first_rule": 100, "rules": rules.tobytes(), "lengths": lengths.tobytes(),
        "symbols": symbols.tobytes(), "doc_ids": [7, None, 9],
        "doc_ends": np.array([1500, 1500, 4000], np.int64).tobytes(), "tokens": 4000,
    }
    monkeypatch.setattr(grammar_tokens, "decode_range", None)
    found = next(grammar_tokens._document_rows(iter([pa.RecordBatch.from_pylist([row])]))).to_pylist()
    assert [(r["doc_id"], r["offset"], r["n_tokens"]) for r in found] == [(7, 0, 1500), (None, 1500, 0), (9, 1500, 2500)]
    assert [r["ids_crc32"] for r in found] == [zlib.crc32(ids[a:b].tobytes()) for a, b in ((0, 1500), (0, 0), (1500, 4000))]


class Counting:
    """A tokenizer that counts the characters it encodes."""

    def __init__(self, tokenizer):
        self.tokenizer, self.seen = tokenizer, 0

    def __getattr__(self, name):
        return getattr(self.tokenizer, name)

    def encode_batch_fast(self, texts, **options):
        self.seen += sum(map(len, texts))
        return self.tokenizer.encode_batch_fast(texts, **options)


def test_known_words_do_not_go_through_the_library_again():
    from tokenizers import Tokenizer

    encoder = Encoder(tokenizer_path())
    encoder.encode(["The cat, sat on 12 mats.\nThe end!! of\nit"])
    counts = []
    for name, value in list(vars(encoder).items()):
        if isinstance(value, Tokenizer):
            counts.append(Counting(value))
            setattr(encoder, name, counts[-1])
    text = "The end, of mats. cat\nThe cat!! on 12.\nit sat"
    whole = encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encoder.encode([text])[0], np.uint32).tolist() == whole
    assert sum(x.seen for x in counts) == 0


@pytest.mark.parametrize("literal", [False, True])
def test_pieces_of_all_kinds_encode_like_whole_texts(monkeypatch, literal):
    from agora.llm import encoding

    monkeypatch.setattr(encoding, "_ROOM", 300)
    encoder = Encoder(tokenizer_path(), literal_specials=literal, cached=500)
    rng = random.Random(9)
    parts = [
        "it's", "we'LL", "'tis", "''", "d'é", "naïve", "“quoted”", "’s", "x’s", "Привет", "中文字", "か゛", "e\u0301", "²", "½x", "Ⅷ", "a1b22",
        "3.14", "--", "…", "😀", "\x00", "\x7f", "_x_", "<|endoftext|>", "Ġ", "Ċ", "\u00ad", "\u200b", "the", "cat.", " ", " ", " ", " ", " ", " ", "\n", "\n",
    ]
    rare = ["\u00a0", "\t", "\u2003", "\u3000", "\x85", "\x1c", "\r\n", "  "]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 12)) + rng.choices(rare, k=rng.random() < 0.1)) for _ in range(3000)]
    for text, ids in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(ids, np.uint32).tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids, text
