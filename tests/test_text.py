"""Text expressions against Python's own string functions."""

import random

import pytest
from pyspark.sql import functions as F

from agora.fixed_values import CLOCK_DATE_FORMAT
from agora.functions import prompts, rewards, stories, text

PIECES = [
    "<reasoning>\n", "\n</reasoning>\n", "\n<answer>\n", "\n</answer>\n", "\n</answer>", "<answer>",
    "</answer>", "<reasoning>", "</reasoning>", "42", "²", "x y", "\n", " ", " ", "é", "####",
    "<think>", "</think>", "3.5", "about 7", " ", "\r",
]


def evaluate(frame, values, make, schema="v string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = frame(rows, "i int, " + schema).select("i", make(F.col("v")).alias("out"))
    return [r["out"] for r in sorted(df.collect(), key=lambda r: r["i"])]


@pytest.fixture(scope="module")
def noise():
    rng = random.Random(5)
    return ["".join(rng.choices(PIECES, k=rng.randint(0, 9))) for _ in range(400)]


def test_unescape_html_order(frame):
    expected = {
        None: None,
        "": "",
        "plain": "plain",
        # entities first, so an escaped paragraph mark counts as one
        "a &lt;p&gt; b<p>c": "a \n\n b\n\nc",
        "I&#x27;m &amp;lt; &copy &notit; &#128512;": "I'm &lt; \u00a9 \u00acit; \U0001f600",
        '<a href="http://x.org/?a=1&amp;b=2" rel="nofollow">x.org</a>!': "http://x.org/?a=1&b=2!",
        '<a href="u"><i>t</i></a>': '<a href="u"><i>t</i></a>',
        "R&D & more": "R&D & more",
        '&lt;a href="q"&gt;w&lt;/a&gt;': "q",
        "price $1 \\1": "price $1 \\1",
    }
    assert evaluate(frame, list(expected), text.unescape_html) == list(expected.values())


def test_strip(frame, noise):
    values = [*noise, "\x1c a \x1f", "　b "]
    assert evaluate(frame, values, text.strip) == [v.strip() for v in values]


def test_counts_and_digits(frame, noise):
    assert evaluate(frame, noise, lambda c: text.count_of(c, "\n</answer>")) == [
        v.count("\n</answer>") for v in noise
    ]
    values = ["12", "", "1.5", "²³", "٣", "12\n", "a1"]
    assert evaluate(frame, values, text.is_digits) == [v.isdigit() for v in values]


def test_parse_number(frame):
    expected = {
        "3": 3.0, "-2.5": -2.5, ".5": 0.5, "5.": 5.0, "1e3": 1000.0, "1_000": 1000.0, "+7": 7.0,
        "inf": float("inf"), "-Infinity": float("-inf"),
        # no number as a whole: the first run of digits
        "1d": 1.0, "2.5f": 2.0, "about 40": 40.0, "0x10": 0.0, "1__0": 1.0, "1e": 1.0, "12 34": 12.0,
        "none": None, "": None,
    }
    assert evaluate(frame, list(expected), text.parse_number) == list(expected.values())
    assert str(evaluate(frame, ["nan"], text.parse_number)[0]) == "nan"


def test_parse_reasoning(frame):
    nan = "nan"
    expected = {
        "<think> a\nb </think><answer> 12.5 </answer>": ("a\nb", "12.5", True, True),
        "<answer>no</answer>": (None, nan, False, False),
        "<think>x</think>": ("x", nan, True, False),
        "<think></think><answer>7 points</answer>": ("", "7.0", True, True),
        "<think>one</think><think>two</think>": ("one", nan, True, False),
        "</think><answer>3": (None, nan, False, False),
        "": (None, nan, False, False),
    }

    def columns(c):
        found = text.parse_reasoning(c)
        return F.struct(*[col.alias(n) for n, col in found.items()])

    got = evaluate(frame, list(expected), columns)
    assert [(r[0], str(r[1]), r[2], r[3]) for r in got] == list(expected.values())


def test_answers(frame):
    tagged = {
        "<answer>4</answer>": "4", "a<answer> b </answer>c": "b", "none": "none", "": "",
        "<answer>1</answer><answer>2</answer>": "2", "x</answer>y": "x", "<answer>open": "open",
    }
    assert evaluate(frame, list(tagged), text.extract_tagged_answer) == list(tagged.values())
    hashed = {"so #### 12 ": "12", "a####b####c": "b", "####": "", "none": None, "": None, "###5": None}
    assert evaluate(frame, list(hashed), text.extract_hash_answer) == list(hashed.values())


def test_rewards(frame):
    good = "<reasoning>\nwhy\n</reasoning>\n<answer>\n42\n</answer>\n"
    expected = {  # strict format, soft format, tags
        good: (0.5, 0.0, 0.5),
        good[:-1]: (0.0, 0.0, 0.501 - 0.001 * len(good[:-1])),
        good + "x": (0.0, 0.0, 0.498),
        "<reasoning>a</reasoning> <answer>b</answer>c": (0.0, 0.5, 0.0),
        "z" + good: (0.0, 0.0, 0.5),
        "<reasoning>a\nb</reasoning><answer>b</answer>": (0.0, 0.0, 0.0),
        "": (0.0, 0.0, 0.0),
    }
    values = list(expected)
    got = [evaluate(frame, values, f) for f in (rewards.reward_strict_format, rewards.reward_soft_format)]
    assert got[0] == [x[0] for x in expected.values()]
    assert got[1] == [x[1] for x in expected.values()]
    assert evaluate(frame, values, rewards.reward_tag_count) == pytest.approx([x[2] for x in expected.values()])
    assert evaluate(frame, [good], lambda c: rewards.reward_correct(c, F.lit("42"))) == [2.0]
    assert evaluate(frame, [good, "no"], rewards.reward_integer) == [0.5, 0.0]
    assert evaluate(frame, ["3", "4"], lambda c: rewards.reward_exact(c, "3")) == [1.0, 0.0]


def test_clean_title(frame):
    values = ['  "A b" ', "'c'", '"', "''", '"x', None, ' "  y " ', "it's"]
    assert evaluate(frame, values, text.clean_title) == ["A b", "c", "", "", '"x', "", "y", "it's"]


def test_flags(frame):
    values = ["True", "true", "t", "False", "", "no"]
    assert evaluate(frame, values, text.parse_flag) == [1, 1, 1, 0, 0, 0]
    assert evaluate(frame, values, text.is_clean_flag) == [True, False, False, True, False, False]


def test_gated_reward(frame):
    df = frame([("ab", 1, 2.5), ("abc", 0, 3.5)], "t string, m int, s double")
    made = rewards.gated_reward(F.col("t"), F.col("m"), F.col("s"))
    rows = df.select(*[c.alias(n) for n, c in made.items()]).collect()
    assert [r["reward"] for r in rows] == [2.5, 0.0]
    assert rows[1]["metrics"] == {"length": 3.0, "matches": 0.0, "rm": 3.5}


def test_xml_escapes(frame):
    assert evaluate(frame, ['<a&"b\'>', None], prompts.xml_text) == [
        "&lt;a&amp;&quot;b&apos;&gt;", None
    ]


def test_story_layouts(frame):
    df = frame([(None, "ann", "a &amp; b<p><a href=\"u\">t</a>", "http://x", "body")],
               "title string, by string, text string, url string, scraped_body string")
    df = df.withColumn("time", F.lit("2020-05-03 22:10:00").cast("timestamp_ntz"))
    row = df.select(*[stories.serialize_story(s).alias(s) for s in stories.STYLES]).first()
    assert row["plain"] == '\nNone\nann, 2020-05-03\n\na & b\n\n<a href="u">t</a>\n'
    assert row["by"] == '\nNone\nby ann, May 03, 2020\n\na & b\n\n<a href="u">t</a>\n'
    assert row["url"] == "URL: http://x"
    assert row["scraped"] == (
        "<submitter>ann</submitter>\n<url>http://x</url>\n<date>2020-05-03</date>\n\n"
        "<body>body</body>\n<title>None</title>"
    )


def test_length_of_the_cleaned_text(frame, noise):
    expected = {
        None: None, "": False, "x" * 10: False, "x" * 11: True, "\u00e9" * 11: True, "\n" * 11: True,
        "&amp;" * 10: False, "&amp;" * 11: True, "1234567890&": True,
        '<a href="u">a very long link text</a>': False, "x&lt;p&gt;" * 4: True,
        'ab<a href="http://long.example.org">t</a>': True, "\U0001f600" * 11: True, "\U0001f600" * 10: False,
    }
    longer = lambda c: text.is_longer_than(c, 10)
    assert evaluate(frame, list(expected), longer) == list(expected.values())
    whole = evaluate(frame, noise, lambda c: F.length(text.unescape_html(c)) > 10)
    assert evaluate(frame, noise, longer) == whole


def test_times(frame):
    times = ["2020-05-03 22:10:00", "2020-05-03 09:10:07.25"]
    df = frame([(t,) for t in times], "t string").select(F.col("t").cast("timestamp_ntz"))
    rows = df.select(
        "t", stories.iso_time(F.col("t")).alias("iso"), stories.day(F.col("t"), CLOCK_DATE_FORMAT).alias("clock"),
        stories.parse_iso_time(stories.iso_time(F.col("t"))).alias("back"),
    ).collect()
    assert [r["iso"] for r in rows] == [r["t"].isoformat() for r in rows]
    assert [r["back"] for r in rows] == [r["t"] for r in rows]
    assert [r["clock"] for r in rows] == [r["t"].strftime("%A %I:%M %p, %Y-%m-%d") for r in rows]
