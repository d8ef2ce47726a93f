"""Classifiers and taggers: held-out accuracy, exact parts by brute force, odd rows."""

import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from agora.llm import language, quality, secret_tags, toxicity
from agora.llm.common import id_bucket
from agora.llm.words import ALNUM, NOT_SPACE, Powers, blocks, hash_words, scan

ODD = [(9000, None), (9001, ""), (9002, " \n\t"), (9003, "123 456"), (None, "plain words"), (9004, "word " * 30_000), (9004, "word " * 30_000)]


def test_scan_finds_the_words_of_each_text():
    texts = ["Über den\nWolken", None, "", "a-b c", "x" * 50, "ABC abc", "end"]
    for member, pattern in ((ALNUM, r"[0-9A-Za-z\x80-\U0010ffff]+"), (NOT_SPACE, r"[^\x20\x09-\x0D]+")):
        found = []
        for block in blocks(pa.array(texts), size=9):
            own = scan(block, member, Powers())
            raw = block.data.tobytes()
            found += [(block.first + d, raw[a:b].decode(), h) for d, a, b, h in zip(own.doc.tolist(), own.start, own.end, own.hash)]
        wanted = [(i, w) for i, t in enumerate(texts) for w in re.findall(pattern, t or "")]
        assert [(d, w) for d, w, _ in found] == wanted
        lower = [re.sub("[A-Z]", lambda m: m[0].lower(), w).encode() for _, w in wanted]
        assert [h for _, _, h in found] == hash_words(lower).tolist()


@pytest.fixture(scope="module")
def corpus(spark):
    """Sentences of invented words; some hold an offence, some documents are junk, two languages."""
    rng = random.Random(4)
    parts = {"aa": ["ka", "to", "mi", "ne", "su"], "bb": ["gro", "schu", "pfa", "ber", "zwi"]}
    rows, labels = [], []
    for i in range(900):
        lang = rng.choice(["aa", "bb"])
        word = lambda: "".join(rng.choices(parts[lang], k=rng.randint(1, 3)))  # noqa: B023, E731
        lines = [" ".join(word() for _ in range(rng.randint(3, 12))) for _ in range(rng.randint(2, 8))]
        toxic, bad = rng.random() < 0.3, rng.random() < 0.3
        if toxic:
            at = rng.randrange(len(lines))
            lines[at] += rng.choice([" vilefool", " vilecur", " vileoaf"]) + " " + word()
        text = (" ### $$ ".join(lines) if bad else ". ".join(lines)) + "."
        rows.append((i, text, lang, "farm" if bad and rng.random() < 0.8 else "press", len(text), 0))
        labels.append((i, int(not bad), int(toxic)))
    for i, text in ODD:
        rows.append((i, text, None, None, None, 0))
    labels += [(5000, 1, 1), (9000, None, None), (None, 0, 1), (3, labels[3][1], labels[3][2])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, word int")
    return docs.cache(), spark.createDataFrame(labels, "doc_id long, quality int, toxic int").cache()


def held_out_accuracy(scored, labels, column):
    known = labels.where(F.col("doc_id") < 5000).select("doc_id", F.col(column).alias("label")).distinct()
    rows = scored.join(known, "doc_id").where(id_bucket(F.col("doc_id"), 5) == 0).select("score", "label").collect()
    assert len(rows) > 100 and all(0 <= r["score"] <= 1 for r in rows)
    return sum((r["score"] >= 0.5) == (r["label"] == 1) for r in rows) / len(rows)


def test_toxic_documents_and_sentences_are_found(corpus, spark):
    docs, labels = corpus
    model = toxicity.train(docs, labels.where(id_bucket(F.col("doc_id"), 5) != 0))
    scored = toxicity.score(docs, model, keep=("doc_id", "text"), locate=True).cache()
    assert scored.count() == docs.count()
    assert held_out_accuracy(scored, labels, "toxic") > 0.97
    odd = {r["doc_id"]: r["score"] for r in scored.where("doc_id >= 9000 or doc_id is null").collect()}
    assert odd[9000] == odd[9001] == odd[9002] == 0 and all(x < 0.5 for x in odd.values())
    for row in scored.where("size(offending) > 0 and doc_id < 900").limit(50).collect():
        assert any("vile" in row["text"][s["start"] : s["end"]] for s in row["offending"])


def test_one_very_long_document_does_not_end_the_sample(corpus, spark):
    docs, labels = corpus
    keys = [r[0] for r in spark.range(10_000, 10_400).orderBy(F.xxhash64("id")).limit(3).collect()]
    long = spark.createDataFrame([(k, "filler words " * 60_000, "aa", "press", 1, 0) for k in keys], docs.schema)
    more, known = docs.unionByName(long), labels.unionByName(
        spark.createDataFrame([(k, 1, 0) for k in keys], labels.schema))
    known = known.where(id_bucket(F.col("doc_id"), 5) != 0)
    found = toxicity.score(docs, toxicity.train(more, known, train_words=100_000))
    assert held_out_accuracy(found, labels, "toxic") > 0.97
    found = quality.score(docs, quality.train(more, known, train_words=200_000))
    assert held_out_accuracy(found, labels, "quality") > 0.9


def test_long_documents_alone_are_still_fitted_on(spark):
    rows = [(i, ("vile rude " if i % 2 else "calm kind ") * 500) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    scored = toxicity.score(docs, toxicity.train(docs, labels, train_words=50_000))
    assert {r["doc_id"] % 2: r["score"] >= 0.5 for r in scored.collect()} == {0: False, 1: True}


def test_noisy_or_by_hand():
    text = "one two. three! two"
    block = next(iter(blocks(pa.array([text]))))
    found = toxicity.sentences(block, Powers())
    weights = np.zeros(toxicity.BUCKETS, np.float32)
    weights[found.bucket[4]] = 3.0  # the word "two" itself, second of the first sentence
    p = toxicity.sentence_scores(found, toxicity.Model(weights, -2.0))
    assert p.tolist() == pytest.approx([1 / (1 + math.exp(-1)), 1 / (1 + math.exp(2)), 1 / (1 + math.exp(-1))])


def test_toxicity_without_labels(corpus):
    docs, labels = corpus
    model = toxicity.train(docs, labels.where("false"))
    assert toxicity.score(docs, model).agg(F.max("score")).first()[0] < 1e-9
    assert toxicity.score(docs.where("false"), model).count() == 0


def test_co_training_beats_either_view(corpus):
    docs, labels = corpus
    few = labels.where((id_bucket(F.col("doc_id"), 5) != 0) & (F.col("doc_id") % 3 == 0))
    scored = quality.score(docs, quality.train(docs.where(id_bucket(F.col("doc_id"), 5) != 0), few)).cache()
    assert scored.count() == docs.count()
    assert held_out_accuracy(scored, labels, "quality") > 0.95
    meta = held_out_accuracy(scored.drop("score").withColumnRenamed("meta_score", "score"), labels, "quality")
    assert meta > 0.8
    assert scored.where("score is null or isnan(score)").count() == 0


def test_quality_without_labels(corpus):
    docs, labels = corpus
    scored = quality.score(docs, quality.train(docs, labels.where("false")))
    assert {round(r["score"], 6) for r in scored.collect()} == {0.5}


def test_languages_are_told_apart(corpus):
    docs, _ = corpus
    held = id_bucket(F.col("doc_id"), 4) == 2
    model = language.train(docs.where(~held))
    found = language.predict(docs, model).cache()
    assert found.count() == docs.count()
    known = found.join(docs.where(held & F.col("lang").isNotNull()).select("doc_id", "lang"), "doc_id")
    assert known.where("lang <> lang_pred").count() == 0 and known.count() > 100
    odd = {r["doc_id"]: r for r in found.where("doc_id between 9000 and 9003").collect()}
    assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in odd.values())
    assert found.where("lang_pred not in ('aa', 'bb', 'und') or score not between 0 and 1").count() == 0


def test_a_tiny_language_stays_beside_a_huge_one(spark):
    rng = np.random.default_rng(2)
    huge = ["".join(map(chr, rng.integers(0x4E00, 0x9FA0, 40_000))) for _ in range(42)]  # 1.7 million 4-grams
    tiny = "quick brown fox"
    rows = [(i, t, "big") for i, t in enumerate(huge)] + [(100, tiny, "small")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(docs)
    assert model.langs == ["big", "small"]
    assert len(model.probs[0][0]) >= 42 * 39_000
    found = {r["doc_id"]: r["lang_pred"] for r in language.predict(docs, model).collect()}
    assert found == {i: lang for i, _, lang in rows}


def test_no_language_to_learn(corpus):
    docs, _ = corpus
    model = language.train(docs.where("false"))
    assert {r["lang_pred"] for r in language.predict(docs.limit(20), model).collect()} == {"und"}


def test_kneser_ney_by_hand():
    texts = ["abab abc", "bca ab"]
    block = next(iter(blocks(pa.array(texts))))
    model = language.build({"x": language.counted(language.grams(block).code)})
    grams = Counter(p[i : i + 4] for t in texts for p in ["\x01\x01\x01" + t] for i in range(len(t)))
    levels = {4: grams}
    for n in (3, 2, 1):
        levels[n] = Counter(g[1:] for g in levels[n + 1])

    def chance(gram):
        n = len(gram)
        counts = levels[n]
        once, twice = (sum(v == k for v in counts.values()) for k in (1, 2))
        cut = once / (once + 2 * twice) if once else 0.5
        after = {g: v for g, v in counts.items() if g[:-1] == gram[:-1]}
        lower = chance(gram[1:]) if n > 1 else 1 / (len(counts) + 1)
        if not after:
            return lower
        total = sum(after.values())
        return max(counts.get(gram, 0) - cut, 0) / total + cut * len(after) / total * lower

    for text in ["abab abc", "cab", "bbb acca", "abz"]:
        block = next(iter(blocks(pa.array([text]))))
        entropy, size = language.entropies(language.grams(block), 1, model)
        padded = "\x01\x01\x01" + text
        wanted = -sum(math.log(chance(padded[i : i + 4])) for i in range(len(text))) / len(text)
        assert size[0] == len(text) and entropy[0, 0] == pytest.approx(wanted, rel=1e-5)


def test_viterbi_is_the_best_of_all_paths():
    rng = np.random.default_rng(0)
    model = secret_tags.Model(None, rng.normal(size=(3, 3)), rng.normal(size=3))
    sizes = [1, 4, 6, 1, 5]
    heads = np.cumsum([0, *sizes[:-1]])
    scores = rng.normal(size=(sum(sizes), 3))
    tags = secret_tags.viterbi(scores, heads, model)
    for head, size in zip(heads, sizes):

        def total(path, head=head):
            steps = sum(model.follow[a, b] for a, b in zip(path, path[1:]))
            return model.first[path[0]] + steps + sum(scores[head + i, y] for i, y in enumerate(path))

        assert tuple(tags[head : head + size]) == max(itertools.product(range(3), repeat=size), key=total)


def test_base_spans_by_the_patterns():
    key = "AKIA" + "ABCDEFGH12345678"
    text = f'é token = "abc123" Api_Key:xyz {key} AKIA12 {"0a" * 12} {"f" * 23}g secret=token=123456 ſecret=abcdef'
    spans = [(k, text[a:b]) for k, a, b, _, _ in secret_tags.base_spans(text)]
    assert spans == [("assign", 'token = "abc123'), ("access", key), ("hex", "0a" * 12), ("assign", "secret=token=123456")]


def test_the_field_adds_what_the_patterns_miss(spark):
    rng = random.Random(8)
    plain = lambda: " ".join("".join(rng.choices("aeioustrn", k=rng.randint(2, 9))) for _ in range(8))
    value = lambda: "".join(rng.choices("0123456789abcdefghkmpqrs", k=28))
    rows = [(i, f"{plain()}\n{plain()} token = {value()} {plain()}\n" + plain()) for i in range(300)]
    rows += [(i, "\n".join(plain() for _ in range(4))) for i in range(300, 900)]
    hidden = value()
    rows += [(1000, f"{plain()} token => {hidden} {plain()}"), *ODD]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = secret_tags.find_secrets(docs, secret_tags.train(docs)).cache()
    assert found.count() == len(rows)
    by_id = {r["doc_id"]: r["spans"] for r in found.collect()}
    assert [rows[-len(ODD) - 1][1][s["start"] : s["end"]] for s in by_id[1000]] == [hidden]
    assert all([s["kind"] for s in by_id[i]] == ["assign"] for i in range(300))
    assert sum(len(by_id[i]) for i in range(300, 900)) == 0
    assert all(by_id[i] == [] for i, _ in ODD)
    assert secret_tags.find_secrets(docs.limit(5), None).count() == 5
