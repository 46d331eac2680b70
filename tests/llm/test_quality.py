import re

from rinkframe.llm import quality

GOOD = "The cat sat on the mat and looked at the birds in the old garden. " * 1 + (
    "Nothing else moved for an hour, until the rain came down and everyone ran inside to wait. "
    "Then the evening news began and nobody spoke about the weather any more, which was odd. "
    "Later the lights went out in half the town, so candles were found and stories were told.")


def by_hand(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        dup += line in seen and bool(re.search(r"[^\x20\x09-\x0D]", line))
        seen.add(line)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    covered = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 8)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered))


TEXTS = ["", "one", "a\n\na\na", "é ü\u00a0x \x0b y#*", GOOD, "a b c d e f g h " * 3, "x " * 40,
         "é" * 5000 + "\n" + "z " * 3000, None, GOOD + "\n" + GOOD]


def test_counts_equal_brute_force():
    for text in TEXTS:
        got = quality.count_text((text or "").encode())[:5]
        assert got == by_hand(text), text and text[:50]


def test_judge_handles_odd_rows_and_keeps_good_texts(documents):
    rows = list(enumerate(TEXTS)) + [(4, GOOD), (None, GOOD)]
    out = quality.judge(documents(rows)).select("doc_id", "text", "quality.*").collect()
    assert len(out) == len(rows)
    for r in out:
        n, *_, repeat = by_hand(r["text"])
        assert r["base_failed"] == (n < 20 or 100 * repeat > 30 * n)
        assert not (r["base_failed"] and r["kept"])
        if r["text"] == GOOD:
            assert r["kept"]
    kept = quality.keep_good(documents(rows))
    assert kept.columns == documents([]).columns and kept.filter("text is null").isEmpty()
    assert quality.judge(documents([])).count() == 0


def test_fit_tells_defects_from_good_texts():
    good, bad = 0, 0
    for v in (1, 0, 1, 0, 0, 1, 0):
        good = good * 3 + v + 1
    for v in (1, 0, -1, 0, 0, 0, 0):
        bad = bad * 3 + v + 1
    p = quality.fit({good: 900, bad: 60})
    assert p[good] > 0.9 and p[bad] < 0.5
    assert quality.fit({}) == {}
    assert quality.fit({good: 1})[good] > 0.5


def test_fit_learns_that_a_rule_is_unreliable():
    def code(*votes):
        out = 0
        for v in votes:
            out = out * 3 + v + 1
        return out
    clean, unended = code(1, 0, 1, 0, 0, 1, 0), code(1, 0, 1, 0, 0, -1, 0)
    defects = {code(1, 0, -1, 0, -1, -1, 0): 30, code(0, -1, -1, 0, 0, 0, 0): 20, code(1, 0, -1, 0, 0, 0, 0): 20}
    p = quality.fit({clean: 6000, unended: 3300} | {c: 10 * n for c, n in defects.items()})
    assert p[clean] > 0.9 and p[unended] > 0.5 and all(p[c] < 0.5 for c in defects)
    shouted = code(1, 0, 1, 0, 0, 1, -1)
    assert quality.fit({clean: 9000, shouted: 60})[shouted] < 0.5
    assert quality.fit({clean: 6000, shouted: 3300})[shouted] > 0.5
