"""Passages of consecutive lines, and messages of very many lines."""
import random
import re
import time

from plenum.llm import quote_threads


def plain_passages(text):
    out = []
    for line in re.split("\r?\n", text or ""):
        marks, content = re.match(r"((?:[ \t]*>)*)[ \t]?(.*)$", line).groups()
        level = marks.count(">")
        if out and out[-1][0] == level:
            out[-1][1] += "\n" + content
        else:
            out.append([level, content])
    return [tuple(p) for p in out]


def test_passages_match_a_plain_reading(spark):
    rng = random.Random(4)
    texts = [None, "", "\n", ">", "> a\nb", "a\n\n> b\n>> c\n> > d\n>e\n"]
    texts += ["\n".join(rng.choice(["", "> ", ">> ", " > >", ">"]) + rng.choice(["", "a", "b c", " "]) for _ in range(rng.randint(1, 30)))
              for _ in range(200)]
    df = spark.createDataFrame([(1, i, "u", t) for i, t in enumerate(texts)], "conv_id long, turn long, role string, text string")
    got = {r.turn: [(p.level, p.content) for p in r.passages] for r in quote_threads._passages(quote_threads.parse(df)).collect()}
    assert got == {i: plain_passages(t) for i, t in enumerate(texts)}


def test_a_message_of_many_lines(spark):
    """100,000 lines, each of another level than the one before; the reply quotes one of them."""
    long = "\n".join((">" * (i % 3) + f" line {i}") for i in range(100_000))
    df = spark.createDataFrame([(1, 0, "u", long), (1, 1, "a", "> line 99999\nyes"), (1, 2, "u", "> no such line")],
                               "conv_id long, turn long, role string, text string")
    begun = time.time()
    got = {r.turn: r for r in quote_threads.thread(df).collect()}
    assert time.time() - begun < 120  # minutes to hours where lines are copied for each line
    assert (got[0].reply_to, got[0].n_quotes, got[1].reply_to, got[2].reply_to) == (None, 66_666, 0, None)
