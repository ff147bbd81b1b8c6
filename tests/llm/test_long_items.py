import random

from corpusmill.llm import splitting


def inside_words(text):
    spans, forced = splitting.split(text)
    assert spans[0][0] == 0 and spans[-1][1] == len(text) and all(0 < b - a <= 1500 for a, b in spans)
    assert all(s[0] == p[1] - 100 and s[1] > p[1] for p, s in zip(spans, spans[1:]))
    return sum(not text[b - 1].isspace() for _, b in spans[:-1]), splitting.named(text, forced)


def test_long_items_are_never_cut_inside_words():
    r = random.Random(7)
    for size in (60_000, 100_000, 300_000):
        words, n = [], 0
        while n < size:
            words.append("b" * r.randint(2, 11) + r.choice(["", "", "", ",", "."]))
            n += len(words[-1]) + 1
        assert inside_words(" ".join(words)) == (0, "natural"), size
    assert inside_words(" ".join(["x" * 900] * 20)) == (0, "natural")
    assert inside_words(" ".join(["x" * r.randint(1, 1390) for _ in range(300)])) == (0, "natural")
    assert inside_words("x" * 1600 + " y" * 20_000)[0] == 1


def fewest_forced(text, limit, overlap):
    """By dynamic programming over every place: the fewest cuts inside words that any cutting needs."""
    n = len(text)
    best = {0: 0}
    for at in range(n):
        if at not in best or n - max(0, at - overlap) <= limit:
            continue
        for to in range(max(at + 1, overlap + 1), min(n - 1, (at - overlap if at else 0) + limit) + 1):
            cost = best[at] + (not (text[to - 1].isspace() and not text[to].isspace()))
            best[to] = min(best.get(to, cost), cost)
    return min(v for at, v in best.items() if n - max(0, at - overlap) <= limit)


def test_no_cutting_has_fewer_forced_cuts():
    r = random.Random(11)
    for _ in range(1500):
        limit = r.randint(12, 40)
        overlap = r.randint(0, limit // 3)
        text = " ".join("x" * r.randint(1, r.choice([5, 12, limit - overlap, limit + 10])) for _ in range(r.randint(2, 40)))
        spans, forced = splitting.split(text, limit, overlap)
        assert spans[-1][1] == len(text) and all(b - a <= limit for a, b in spans)
        assert forced == (fewest_forced(text, limit, overlap) if len(text) > limit else 0), (text, limit, overlap)
