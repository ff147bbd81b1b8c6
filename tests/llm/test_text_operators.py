import random
import unicodedata

from corpusmill.llm import encoding, leaks, lookalikes, markup, scans, splitting, tokens

USUAL = "Kdo je hitro gledal hišo, ko je vlak stal pri beli peči. Mati je počasi pela pesem starega romana."


def test_cuts_do_not_change_the_encoding():
    r = random.Random(2)
    plain = tokens.encoding().encode_ordinary
    alphabet = ["a", "č", " ", "  ", "\n", "1", ".", "don't", "🙂", "\xa0", "日", " \n", "\t"]
    for _ in range(300):
        text = "".join(r.choice(alphabet) for _ in range(r.randint(0, 60)))
        pieces = tokens.cuts(text, 7)
        assert "".join(pieces) == text and [i for p in pieces for i in plain(p)] == plain(text)
        assert tokens.decode(plain(text)) == text
    assert tokens.encoder()(None) == [] and tokens.encoder()("") == [] and tokens.counter()(USUAL) == len(plain(USUAL))
    long = USUAL * 2000
    assert tokens.encoder()(long) == plain(long)


def test_token_budget(spark):
    df = spark.createDataFrame([("dlib", "sl", "https://A.example/x", "Ana Bor", "ena dve"), (" DLIB", "slv", "https://a.example/y", "BOR, ANA", None), ("wiki-vir", None, None, None, "tri")], "source string, lang string, url string, author string, text string")
    names = spark.createDataFrame([("Ana Bor",)], "name string")
    rows = {(r["slice"], r["source"], r["lang"], r["host"], r["author"]): (r["n_docs"], r["n_tokens"]) for r in tokens.token_budget(df, "c", names).collect()}
    n = tokens.counter()
    assert rows["all", None, None, None, None] == (3, n("ena dve") + n("tri"))
    assert rows["source+lang+host", "dlib", "sl", "a.example", None] == (2, n("ena dve")) and rows["source", "wikivir", None, None, None] == (1, n("tri"))
    assert rows["author", None, None, None, "Ana Bor"] == (2, n("ena dve"))


def test_scan_repair(words):
    repair = scans.reader(words)
    page = "Kdo je hi†ro gledal hišo, ko je vlak stal pri be-\n\nStran 12\n\x0cVečer ob gori\nli peči. Mati je počasi pela\npesem starega rornana."
    text, damage = repair(page)
    assert damage == ["furniture", "misread", "split"] and "beli peči" in text and "hitro" in text and "romana" in text and "Stran" not in text
    assert repair(USUAL) == (USUAL, [])
    assert repair("V trgu so stale eno-\nin dvonadstropne hiše.")[1] == []
    for line in ("— 12 —", "[7]", "3 0 8", "- 9 -", "182     BREZOVAR", "SUHA SLUŽBA     35", "Hruškar, Vesel golob. IV.        176*"):
        assert scans.furniture(["pela je", line, "pesem"]) == [False, True, False], line
    for line in ("I.", "II.", "17.", "LOVRO:", "Leta 1888", "(gl. tab. 2b)."):
        assert scans.furniture(["pela je", line, "pesem"]) == [False, False, False], line
    assert repair("Kdojehitrogledalhišo") == ("Kdo je hitro gledal hišo", [])


def test_markup():
    clean = markup.cleaner()
    text, found = clean('<html><body><h2 class="a">Ura</h2><p>Mati &scaron;e <b>poje</b>.<br/>Da.</p><ul><li>ena</li></ul><pre><code>if a &lt; b:</code></pre></body></html>')
    assert found == ["html"] and "## Ura" in text and "Mati še poje.\nDa." in text and "- ena" in text and "```\nif a < b:\n```" in text
    text, found = clean("== Ura ==\n'''Mati''' [[Delo|poje]]. [[Kategorija:X]]\n{{pesem|\nverz\n}}")
    assert found == ["wiki"] and text.startswith("== Ura ==".replace("==", "##").split(" ##")[0]) and "Mati poje." in text and "verz" in text and "{" not in text
    text, found = clean("\\section{Ura} % x\n\\begin{itemize}\n\\item po\\v{c}asi \\textbf{pela}\n\\end{itemize}\n\\[ a_{n+1} = 2 \\]\n\\begin{verbatim}\nx\n\\end{verbatim}")
    assert found == ["latex"] and "## Ura" in text and "- počasi pela" in text and "\\[ a_{n+1} = 2 \\]" in text and "```\nx\n```" in text
    text, found = clean("Ura\n===\n\n**Mati** _poje_ [tu](https://a.example).[^1]\n\n```py\nx = '**a**'\n```\n\n| a | b |\n|---|--:|\n| 1 | 2 |")
    assert found == ["markdown"] and text.startswith("# Ura") and "Mati poje tu." in text and "x = '**a**'" in text and "1 | 2" in text
    for plain in ("5 * 3 = 15 in $16", "a < b in b > 2", "Jožar (* 1793, Vas, † 1838)", "del [...] in *", "polje ______ je", "zvezek #47", "- 375 -", "Bil je\n1. maj", "AT&T in R&D", "ena_dva_tri"):
        assert clean(plain) == (plain, []), plain


def test_dropped_paths():
    table = [("text", 100, 50_000, 2000), ("html.p", 100, 20_000, 800), ("html.div/html.nav", 50, 700, 0), ("html.div/html.menu", 5, 60, 0), ("html.div", 40, 900, 30)]
    assert markup.dropped_paths(table) == {"html.div/html.nav"}
    assert markup.dropped_paths([]) == frozenset()


def test_markup_keeps_the_words():
    """Headings closed by a wrong tag, open paragraphs, fenced code, cells and items keep all their words."""
    clean = markup.cleaner(frozenset({"html.body/html.h3", "html.body/html.div", "html.body", "text"}) - {"text"})
    text, found = clean('<html><head><title>Naslov</title><style>p {color: red}</style></head><body><h3 class="a">Ura</h2><p>Mati <b>poje.<p>Kmet dela</b>.<ul><li>ena<li>dve</ul><table><tr><td>levo<td>desno</table><ol><li>prva</li><li>druga</li></ol></body></html>')
    assert found == ["html"] and text == "### Ura\n\nMati poje.\n\nKmet dela.\n\n- ena\n- dve\n\nlevo | desno\n\n1. prva\n\n2. druga", text
    text, found = clean("<body><div>\n```py\nx = 1\n```\n<nav>meni</nav></div>")
    assert found == ["html", "markdown"] and "x = 1" in text
    deep = "[[" * 9 + "jedro" + "]]" * 9 + " {{a|{{b|{{c|{{d|{{e|vsebina}}}}}}}}}} in " + "\\textbf{" * 6 + "konec" + "}" * 6
    text, found = clean(deep)
    assert found == ["wiki", "latex"] and "jedro" in text and "vsebina" in text and "konec" in text and not set("[]{}\\") & set(text)
    text, _ = clean("\\section{A}\nStane 50 % cene. % opomba\n\\neznano{x} \\textbf{y}")
    assert "50 % cene." in text and "opomba" not in text and "\\neznano{x} y" in text
    text, _ = clean("{{naslov|Ura|leto=1902}}\n{|\n! delo !! leto\n|-\n| style=\"a\"|Drama\n| 1884\n|}\n[[Slika:a.jpg|thumb|Podpis [[Delo|dela]]]]\n[[Kategorija:X]]")
    assert text.startswith("# Ura 1902") and "delo | leto\nDrama | 1884" in text and "Podpis dela" in text and "Kategorija" not in text


def test_navigation_goes_by_its_ratio(spark):
    rows = [(i, f"<div><nav><a>Domov</a> <a>Iskanje {i}</a></nav></div><p>{USUAL}</p><div>{USUAL}</div>") for i in range(400)]
    got = [r["text"] for r in markup.clean_markup(spark.createDataFrame(rows, "row_id bigint, text string")).collect()]
    assert all("Iskanje" not in t and t.count("Mati je") == 2 for t in got)


def garbled_rows():
    usual = ["Počasi je pela žena pri beli peči.", "Moker založnik je čakal večer.", "»Živel romar,« je delal šolar, »ognjišče!«"] * 30
    rows = [(i, "dlib", t) for i, t in enumerate(usual)]
    pairs = [("utf-8", "latin-1"), ("utf-8", "cp1250"), ("cp1250", "latin-1"), ("utf-8", "cp852"), ("cp852", "cp1250")]
    bad = [(1000 + 10 * i + j, "dlib", t.encode(a).decode(b, errors="replace")) for i, (a, b) in enumerate(pairs) for j, t in enumerate(usual[:3])]
    return rows, bad, dict((1000 + 10 * i + j, t) for i in range(len(pairs)) for j, t in enumerate(usual[:3]))


def test_encoding_repair(spark):
    rows, bad, truth = garbled_rows()
    foreign = [(5000, "dlib", "Gospa Adèle iz Ærøja, São Tomé, CORAÇÃO, naïve façade, opomba¹ ¾ § 12 °C"), (5001, "dlib", "Kaj je to? Počasi!")]
    got = {r["row_id"]: (r["text"], r["garbled"]) for r in encoding.restored(spark.createDataFrame(rows + bad + foreign, "row_id bigint, source string, text string")).collect()}
    assert all(not got[i][1] and got[i][0] == t for i, _, t in rows + foreign)
    assert sum(got[i][1] for i, *_ in bad) >= 0.9 * len(bad)
    right = sum(a == b for i, t in truth.items() for a, b in zip(got[i][0].split(), t.split()))
    assert right >= 0.8 * sum(len(t.split()) for t in truth.values())
    lost = encoding.restorer({}, encoding.Lexicon({"počasi": 90, "žena": 90, "je": 500}, 100))
    assert lost("dlib", "Po?asi je ?ena") == ("Počasi je žena", True) and lost("dlib", "Kdo je žena?")[1] is False and lost("dlib", "po�asi")[1] is True


def test_lookalikes(words):
    one = lookalikes.normalizer(words)
    for odd in ("hi\u200bšo", "ｈišo", "𝐡𝐢š𝐨", "hiš\u043e", unicodedata.normalize("NFD", "hišo"), "h\u2060išo"):
        assert one(odd) == ("hišo", True), odd
    assert one("Mati\xa0je") == ("Mati je", True) and one("ognǉivega")[1] and one("ﬁ")[0] == "fi"
    for usual in ("beseda книга in λόγος", "co\xadop ½ x² … „a“ – —", "Straße façade", "नमस्ते", "日本語"):
        assert one(usual)[1] is False, usual
    assert one("hi\u0429o") == ("hišo", True) and one("\u0429xq")[1] is True
    twice, _ = one(one("Рočаsі je реlа")[0])
    assert twice == one("Рočаsі je реlа")[0] == "Počasi je pela"


def test_splitting():
    r = random.Random(4)
    for _ in range(60):
        text = "".join(r.choice(["beseda ", "stavek. ", "vrsta\n", "\n\n", "x" * r.randint(1, 900)]) for _ in range(r.randint(1, 400)))
        spans, forced = splitting.split(text)
        assert spans[0][0] == 0 and spans[-1][1] == len(text) and all(b - a <= 1500 for a, b in spans)
        assert all(s[0] == p[1] - 100 and s[1] > p[1] for p, s in zip(spans, spans[1:]))
        if len(text) > 1500:
            assert splitting.named(text, forced) == ("forced" if splitting.longest_run(text) > 1500 else "natural")
    assert splitting.split(None) == ([], 0) and splitting.split("") == ([], 0) and splitting.split("a" * 1500) == ([(0, 1500)], 0)
    spans, forced = splitting.split("a" * 5000)
    assert splitting.named("a" * 5000, forced) == "forced" and forced == 3 and len(spans) == 4
    whole = ("Stavek je tu. " * 107 + "\n\n") * 3
    spans, _ = splitting.split(whole)
    assert all(whole[:b].rstrip(" ").endswith((".", "\n")) for _, b in spans[:-1])


def differing(a, b):
    rows = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, rows[0] = rows[0], i
        for j, y in enumerate(b, 1):
            last, rows[j] = rows[j], min(rows[j] + 1, rows[j - 1] + 1, last + (x != y))
    return rows[-1]


def test_myers_equals_dynamic_programming():
    r = random.Random(6)
    for _ in range(150):
        p, t = ("".join(r.choice("abc") for _ in range(r.randint(1, n))) for n in (12, 25))
        assert leaks.myers(p, t) == min(differing(p, t[i:j]) for i in range(len(t) + 1) for j in range(i, len(t) + 1))


def leak_rows(n=160):
    r = random.Random(9)
    syllables = "ba da ga ka la ma na pa ra ta va za ži če šo mi ro lu".split()
    word = lambda: "".join(r.choice(syllables) for _ in range(r.randint(2, 4)))
    works = [(i, [word() for _ in range(200)]) for i in range(4)]
    rows, truth = [], set()
    for k in range(n):
        item, words = works[k % 4]
        size, wrong = r.choice([(30, 0), (30, 2), (40, 4), (26, 2), (20, 0), (30, 9), (60, 5)])
        at = r.randint(0, 200 - size)
        part = list(words[at : at + size])
        for i in r.sample(range(size), wrong):
            part[i] = word() + "xq"
        bad = [p != w for p, w in zip(part, words[at : at + size])]
        leaked = any(sum(bad[a : a + m]) <= m * 0.1 for m in range(25, size + 1) for a in range(size - m + 1))
        text = " ".join([word() for _ in range(40)] + part + [word() for _ in range(40)])
        style = k % 5
        text = text.upper() if style == 1 else text.replace("č", "c").replace("ž", "z").replace("š", "s") if style == 2 else text.encode().decode("cp1250", errors="ignore") if style == 3 and leaked else text
        rows.append((k, f"u{k}", text))
        if leaked:
            truth.add((item, k))
    return [(i, f"w{i}", " ".join(w)) for i, w in works], rows, truth


def test_leaks_equal_brute_force(spark):
    works, rows, truth = leak_rows()
    schema = "{} bigint, url string, text string"
    corpus = spark.createDataFrame([*rows, (900, "w1", works[1][2]), (901, None, works[2][2])], schema.format("row_id"))
    got = {(r["item_id"], r["row_id"]) for r in leaks.leaks(corpus, spark.createDataFrame(works, schema.format("item_id"))).collect()}
    assert got == truth | {(2, 901)}
