"""Texts, patterns and numbers that results depend on.

They have to be exactly these for results to agree with earlier datasets, so
they are stated here as they are, in one place.
"""

# --- thresholds -----------------------------------------------------------
MIN_ROOT_SCORE = 100
CLOSURE_MAX_RANK = 3
CLOSURE_ROUNDS = 6
MIN_SIBLINGS = 5
MAX_SIBLINGS = 25
MIN_TEXT_CHARS = 10
PAIR_WINDOW_SECONDS = 1800
MAX_NESTED_LEVEL = 24
MAX_BODY_CHARS = 4000
REGRESSION_START = "2016-01-01 00:00:00"
REPORT_END = "2024-10-01 00:00:00"
SPLIT_WEIGHTS = (("train", 0.8), ("test", 0.1), ("val", 0.1))
SAMPLE_SEED = 42
PAIR_SAMPLE_SIZE = 100_000
PAIR_SPLIT_SIZES = {"train": 30_000, "validation": 500, "test": 1_000}
COMMENT_SAMPLE_SIZE = 100_000

# --- patterns and formats -------------------------------------------------
LINK_PREFIX = "https://news.ycombinator.com/item?id="
HIRING_TITLE = "Who is hiring"
ANCHOR_PATTERN = '<a href="([^"]+)"[^>]*>[^<]+</a>'
DAY_FORMAT = "yyyy-MM-dd"
LONG_DATE_FORMAT = "MMMM dd, yyyy"
CLOCK_DATE_FORMAT = "EEEE hh:mm a, yyyy-MM-dd"
THINK_PATTERN = r"(?s)<think>(.*?)</think>"
ANSWER_PATTERN = r"(?s)<answer>(.*?)</answer>"
STRICT_FORMAT_PATTERN = r"^<reasoning>\n.*?\n</reasoning>\n<answer>\n.*?\n</answer>\n$"
SOFT_FORMAT_PATTERN = r"<reasoning>.*?</reasoning>\s*<answer>.*?</answer>"

# --- prompt texts ---------------------------------------------------------
COMMENT_INSTRUCTIONS = (
    "Your goal is to analyze the following comment and estimate how highly it "
    "will be upvoted by the Hacker News community."
)
TITLE_SYSTEM = (
    "You are a helpful assistant that generates engaging titles for Hacker News "
    "posts. Respond with just the title, no other text."
)
TITLE_REQUEST = (
    "Generate a concise, engaging title for this Hacker News submission. The title "
    "should be informative yet catchy.\n\nContent: "
)
MATCH_SYSTEM = (
    "You are a moderator for Hacker News. You are given the body of an article, as "
    "well as a proposed title. You are to determine whether the title makes any "
    "claims that are not substantiated by the article body. If there are any "
    "unsubstantiated claims, you should return False. Otherwise, you should return "
    "True. Only return False or True, no other text."
)
REASONING_REQUEST = """Given the following Hacker News submission, predict the number of upvotes it received. 
First reason through your prediction step by step, then provide your final numerical prediction.

Your response should follow this format exactly:
<think>
Your step-by-step reasoning here...
</think>
<answer>predicted_number_of_upvotes</answer>

Here is the submission:

"""

# Columns of the story dataset.
STORY_COLUMNS = (
    "id", "title", "by", "text", "score", "descendants", "time", "log_score", "serialized", "split"
)

# Tags of the tag reward, points per tag and per trailing character.
REASONING_OPEN = "<reasoning>\n"
REASONING_CLOSE = "\n</reasoning>\n"
ANSWER_OPEN = "\n<answer>\n"
ANSWER_CLOSE_LINE = "\n</answer>\n"
ANSWER_CLOSE = "\n</answer>"
TAG_POINTS = 0.125
TRAILING_POINTS = 0.001

# Columns of the published reports, in their order.
STORY_REPORT = ("serialized", "predicted_score", "score", "score_diff", "link")
COMMENT_REPORT = ("date", "by", "link", "story_title", "text", "reward")
