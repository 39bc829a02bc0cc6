"""Line rules and the verdict of the quality rules, against a plain Python version."""

import random

import regex
from pyspark.sql import functions as F

from gleanwork.llm import quality_rules as rules

WORD = regex.compile(r"[^\x20\x09-\x0D]+")


def fails(line):
    words = WORD.findall(line)
    n = len(words)
    symbols = sum(c in "#*$%&|<>" for c in line)
    if symbols and symbols * 4 >= n:
        return True
    in_runs = sum(len(m) for m in regex.findall(r"[!?.]{3,}", line))
    if in_runs and in_runs * 4 >= sum(map(len, words)):
        return True
    if words and not regex.search(r"[\p{L}\p{N}]", line):
        return True
    loud = sum(len(regex.findall(r"\p{Lu}", w)) >= 2 and not regex.search(r"\p{Ll}", w) for w in words)
    if n >= 5 and 2 * loud > n:
        return True
    bars = sum(c in "|»›•→" for c in line)
    if bars >= 3 and len(regex.findall(r"[^\x20\x09-\x0D|»›•→]+", line)) <= 4 * (bars + 1):
        return True
    return len(line) <= 300 and any(p in line.lower() for p in rules.BOILERPLATE)


def verdict(text):
    words = WORD.findall(text or "")
    lines = (text or "").split("\n")
    gone = [x for x in lines if fails(x)]
    lost = sum(len(w) for x in gone for w in WORD.findall(x))
    grams = {}
    for i in range(len(words) - 2):
        grams.setdefault(tuple(words[i : i + 3]), []).append(i)
    hit = {j for places in grams.values() if len(places) > 1 for i in places for j in range(i, i + 3)}
    base = len(words) < 50 or 100 * len(hit) > 50 * len(words)
    kept = not base and not lost > 0.3 * sum(map(len, words))
    return kept, len(gone), lost, text if not gone else "\n".join(x for x in lines if not fails(x))


BAD = ["BUY NOW THE BEST CHEAP THINGS HERE ok", "Home›News›Shop›About", "Home | News | Sport | Shop", "!!!!! wow !!!!!!", "-----", "*** ***",
       "We use cookies to serve you", "a# b# c#"]
GOOD = ["", "  ", "The NASA and ESA teams met in Paris and agreed.", "Wait... what did they say after that long and quiet evening?",
        "I AM HERE", "A B C D E F", "He said: no!", "1 2 3", "left | right is one bar", "Ünder ÖL prices rose again."]


def test_lines(spark):
    lines = spark.createDataFrame([(x,) for x in BAD + GOOD], "line string").select("line", rules.failing(F.col("line")).alias("bad")).collect()
    assert {r.line for r in lines if r.bad} == set(BAD)
    assert all(r.bad == fails(r.line) for r in lines)


def test_verdicts(spark):
    rng = random.Random(5)
    parts = ["the", "Word", "CAPS", "XX", "ÉÀ", "a|b", "›", "•", "!!!", "...", "x#", "ok.", "we use cookies", "--", "É", "9"]
    texts = [None, "", "\n\n"]
    for _ in range(400):
        lines = []
        for _ in range(rng.randint(1, 14)):
            if rng.random() < 0.6:
                lines.append(" ".join(f"w{rng.randint(0, 500)}" for _ in range(rng.randint(1, 30))))
            else:
                lines.append(" ".join(rng.choice(parts) for _ in range(rng.randint(0, 8))))
        texts.append("\n".join(lines))
    texts.append("\n".join(["w%d and so on" % i for i in range(3000)] + ["A | B | C | D"]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").withColumn("quality", F.lit("taken"))
    got = {r.doc_id: r for r in rules.quality_rules(docs).collect()}
    want = {i: verdict(t) for i, t in enumerate(texts)}
    assert {i: (r.quality.kept, r.quality.n_removed_lines, r.quality.removed_chars, r.quality.cleaned_text) for i, r in got.items()} == want
    assert 0 < sum(w[0] for w in want.values()) < len(texts)
    left = {r.doc_id: r.quality for r in rules.kept_documents(docs).collect()}
    assert left == {i: r.quality for i, r in got.items() if r.quality.kept}
    assert rules.kept_documents(docs.limit(0)).count() == 0
