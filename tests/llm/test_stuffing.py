import random

import pytest

from chromaloom.llm import stuffing as s

WORDS = "we they reads bin sample the a of map found near lost count after before gene probe wash spin cell data keep plot under over slow fast new old deep cold warm".split()


def prose(r, n):
    out = ""
    while len(out) < n:
        out += " ".join(r.choices(WORDS, k=r.randint(9, 16))).capitalize() + f" at {r.randint(10, 999)} of {r.choice('abcdefgh')}{r.randint(1, 99)}. "
    return out[:n]


def keywords(r, n):
    keys = r.sample(["oligo pool", "probe kit", "nuclei buffer"], 2)
    return " | ".join(f"{r.choice(['cheap', 'buy', 'best', 'top'])} {r.choice(keys)}" for _ in range(n // 16))[:n]


def links(r, n):
    return "".join(f"https://www.shop{r.randint(1, 99)}.example/item/{r.randint(1000, 99999)}\n" for _ in range(n // 45))


def sentences(r, n):
    return " ".join(f"Why oligo pool? Oligo pool {r.choice(['online', 'cheap', 'now'])}, oligo pool price." for _ in range(n // 50))


def log(r, n):
    return "".join(f"{r.randint(10, 23)}:{r.randint(10, 59)}:{r.randint(10, 59)} WARN cannot open run.log\n" for _ in range(n // 34))


def shares(spark, rows):
    return {x.doc_id: x.share for x in s.stuffed_share(spark.createDataFrame(rows, "doc_id long, text string, lang string"), "doc_id", "text", "lang").collect()}


def test_stuffing_among_prose(spark):
    r = random.Random(1)
    rows = [(i, prose(r, r.randint(300, 3000)), r.choice(["en", "EN", None])) for i in range(300)]
    spam = [(1000 + i, f(r, 1500), "en") for i, f in enumerate([keywords, links, sentences] * 8)]
    mixed = [(2000 + i, prose(r, 700) + "\n" + f(r, 1900), "en") for i, f in enumerate([keywords, links, sentences] * 4)]
    little = [(3000 + i, prose(r, 2500) + "\n" + f(r, 700) + "\n" + prose(r, 500), "en") for i, f in enumerate([keywords, links, sentences] * 4)]
    data = [(4000 + i, log(r, 1500), "en") for i in range(8)]
    got = shares(spark, rows + spam + mixed + little + data)
    found = {k for k, v in got.items() if v > 0.5}
    assert found == {k for k, *_ in spam + mixed}


@pytest.mark.parametrize("disguise", [lambda t: t.upper(), lambda t: t.replace("o", "0").replace("e", "3"), lambda t: "\u200b".join(t), lambda t: t.replace("p", "pp")])
def test_disguises_change_nothing_much(disguise):
    text = keywords(random.Random(2), 1200)
    plain, other = s.windows(text), s.windows(disguise(text))
    assert abs(plain[1][1] - other[1][1]) < 80


def test_windows_own_all_characters():
    r = random.Random(3)
    for n in (0, 1, 200, 640, 641, 5000):
        text = prose(r, n) if n else ""
        w = s.windows(text)
        assert sum(x[3] for x in w) == sum(b & 0xC0 != 0x80 for b in s.normalised(text))
        assert all(x[3] >= 0 for x in w)


def test_characters_are_those_of_the_text():
    for text, n in (("reads 47 in 9", 13), ("x" + "acgt" * 40, 161), ("\u6838\u9178 12", 5)):
        assert abs(sum(b & 0xC0 != 0x80 for b in s.normalised(text)) - n) <= 1


def test_both_measures_are_needed(spark):
    r = random.Random(7)
    usual = [(i, prose(r, r.randint(300, 3000)), "en") for i in range(300)]
    report = "".join(f"Step {k} passed after {r.randint(2, 59)} minutes, and the operator signed the sheet. " for k in range(1, 25))  # repeats, in sentences that say something
    words = " ".join("".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=r.randint(3, 9))) for _ in range(300))  # no sentence, no repetition
    got = shares(spark, [*usual, (1000, report, "en"), (1001, words, "en"), (1002, keywords(r, 1500), "en")])
    assert [got[k] > 0.5 for k in (1000, 1001, 1002)] == [False, False, True]


def test_short_texts_are_judged_against_texts_as_short(spark):
    r = random.Random(8)
    usual = [(i, " ".join(r.choices(WORDS, k=r.randint(11, 30))) + f" at {r.randint(10, 999)}.", "en") for i in range(600)]
    got = shares(spark, [*usual, (1000, keywords(r, 150), "en"), (1001, "#oligo_pool #oligo_pool_sale #nuclei_buffer #probe_kit_sale #probe_kit", "en")])
    assert {k for k, v in got.items() if v > 0.5} == {1000, 1001}


def test_sentences_that_repeat_do_not_count():
    new = b"the capture library was sequenced on a second flow cell today. "
    assert len(s.sentence_ends(new)) == 1 and len(s.sentence_ends(new * 5)) == 1
    assert len(s.sentence_ends(s.normalised("".join(f"Day {k}: the cells looked fine, and {k + 7} dishes were passaged. " for k in range(1, 9))))) == 8


def test_usual_ratios_are_exact_and_lean_on_all_languages(spark):
    rows = [(k, "en", [(30, 500 + k, 0.0, 1)]) for k in range(100)] + [(1000 + k, "xx", [(30, 100, 0.0, 1)]) for k in range(2)]
    got = {r.lang: r.usual for r in s.usual_ratios(spark.createDataFrame(rows, s.MEASURED).repartition(7)).collect()}
    weight = lambda q: sum(1 + 100 / 102 for k in range(100) if 500 + k <= q) + 200 / 102
    assert got["en"][30] == next(q for q in range(500, 600) if weight(q) >= 0.8 * 200)
    assert got["xx"][30] > 500  # two windows don't make a standard of their own


def test_edges(spark):
    rows = [(1, None, "en"), (2, "", None), (3, "\xa0", "und"), (4, "ab", "x'y"), (5, "buy " * 200_000, "en"), (5, "buy " * 200_000, "en")]
    got = shares(spark, rows)
    assert [got[k] for k in (1, 2, 3, 4)] == [0.0] * 4
    assert s.stuffed_share(spark.createDataFrame([], "doc_id long, text string, lang string"), "doc_id", "text", "lang").count() == 0
