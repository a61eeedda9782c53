"""Language identification: each kind of evidence, odd rows."""

import math
import re
from collections import Counter

from pyspark.sql import functions as F

from helpers import documents
from ledgerloom.llm import language
from ledgerloom.llm.common import read

WORDS = {"en": "the cat sat with that thing and they went there together for this weather",
         "de": "der hund und die katze sind nicht schlecht aber auch zwischen durch gegen",
         "fr": "le chat est dans la maison avec une belle fleur pour vous et les enfants"}


def texts(n=60):
    out = []
    for k in range(n):
        for lang, words in WORDS.items():
            w = words.split()
            out.append((lang, " ".join(w[(k * 5 + j * (1 + k % 3)) % len(w)] for j in range(12)), f"{'www' if k % 2 else 'blog'}.site-{lang}.{lang if lang != 'en' else 'com'}"))
    return out


def identify(spark, rows, **more):
    frame = spark.createDataFrame([(i, *r, "x", 1.0) for i, r in enumerate(rows)], "n int, says string, body string, at string, host string, gain double")
    got = language.identify(frame, "body", F.col("says"), F.col("at"), keep=("n", "host", "gain"), **more)
    return {r[0]: r for r in got.collect()}


def lang(r):
    return r[5], r[8]


def test_texts_win_over_wrong_declarations(spark):
    rows = texts()
    rows += [("en", t, a) for l, t, a in rows[1:30:3]]  # German that declares English
    got = identify(spark, rows)
    assert all(lang(got[i]) == (l, True) for i, (l, _, _) in enumerate(texts()))
    assert [lang(got[180 + k])[0] for k in range(10)] == ["de"] * 10
    assert got[0][1:3] == ("x", 1.0)  # kept columns are the input's


def test_declaration_and_host_decide_where_the_text_does_not(spark):
    got = identify(spark, [*texts(), ("de", "yy", None), (None, "zz", "www.site-fr.fr"), (None, "zz", "http://new.site.fr/page"), (None, "zz", None)])
    assert lang(got[180])[0] == "de" and lang(got[181])[0] == "fr" and lang(got[182])[0] == "fr"
    # a host that is new takes its suffix's prior; a known host is surer
    assert got[182][6] < got[181][6]


def test_odd_rows(spark):
    rows = [*texts(20), (None, None, None), ("en", "", "http://"), ("xx-long-tag", "12 34 !!", "a"), (None, "日本語" * 30, "b"), (None, "the cat " * 50_000, None)]
    got = identify(spark, rows)
    assert len(got) == 65
    assert [got[60 + k][8] for k in range(3)] == [False] * 3 and lang(got[64]) == ("en", True)
    assert not got[63][8]  # no language explains it


def test_without_any_language(spark):
    got = identify(spark, [(None, "some text", None), (None, None, None)])
    assert [lang(r) for r in got.values()] == [(None, False)] * 2
    assert identify(spark, []) == {}


def test_addresses(spark):
    frame = spark.createDataFrame([("https://WWW.a.Co.uk:80/x?y#z",), ("src0",), ("http://b.de",), ("",), (None,)], "a string")
    host = language.host_of(F.col("a"))
    got = [tuple(r) for r in frame.select(host, language.suffix_of(host)).collect()]
    assert got == [("www.a.co.uk", "uk"), ("src0", None), ("b.de", "de"), (None, None), (None, None)]
    tags = spark.createDataFrame([("<html lang='en-GB'>",), ("<HTML class=a LANG=de>",), ("<p lang=fr>",), (None,)], "h string")
    assert [r[0] for r in tags.select(language.markup_language(F.col("h"))).collect()] == ["en", "de", None, None]


def test_tables(spark):
    docs = read(spark, "/root/testdata/sf0.01", "documents")
    got = language.identify(docs, "text", F.lit(None).cast("string"), F.col("source"), keep=("doc_id",))
    assert got.where("accepted").count() == 0  # nothing to learn from
    got = language.identify(docs, "text", F.col("lang"), F.col("source"), keep=("doc_id",)).collect()
    assert len(got) == docs.count() and all(r["accepted"] and r["lang"] == r["declared"] for r in got)


def test_repeated_rows_count_each(spark):
    assert len(identify(spark, [("en", "the same text", "a")] * 5)) == 5
    assert documents(spark, []).count() == 0


def test_every_declared_language_is_known_in_a_table_of_any_size(spark):
    # 70 languages of three texts each, with letters of their own, beside one that fills the table
    tags = [f"{a}{b}" for a in "qxyz" for b in "abcdefghijklmnopqr"][:70]
    words = {t: [chr(0x4E00 + 40 * i + k) + chr(0x4E00 + 40 * i + (k * 7 + 3) % 40) for k in range(40)] for i, t in enumerate(tags)}
    rare = [(t, " ".join(words[t][(j * 3 + k) % 40] for k in range(30)), f"{t}.site") for t in tags for j in range(3)]
    rows = [*rare, *((None, " ".join(words[t][5:25]), None) for t in tags), *(texts(1)[0] for _ in range(10_000))]
    got = identify(spark, rows)
    assert [lang(got[i]) for i in range(210)] == [(t, True) for t, *_ in rare]
    assert [lang(got[210 + i]) for i in range(70)] == [(t, True) for t in tags]
    assert all(lang(got[i]) == ("en", True) for i in range(280, len(rows)))


def test_a_rare_language_is_fitted_on_all_its_texts(spark):
    common, rare = texts(60), [("fr", t, a) for l, t, a in texts(30) if l == "fr"]
    rows = [r for r in common if r[0] != "fr"] * 5 + rare
    frame = spark.createDataFrame([(t, l) for l, t, _ in rows], "text string, declared string").withColumns(
        {"key": F.struct("text"), "markup": F.lit(False)})
    whole, part = language.fit(frame), language.fit(frame, 30)
    of = lambda m: m.missing[m.languages.index("fr")]
    assert of(part) == of(whole) and part.missing[0] > whole.missing[0]


def by_hand(rows):
    """(lang, confidence, gain) of each (declares, text, host), in plain Python."""
    def grams(text):
        kept = "".join(c.lower() if c.isascii() and c.isalpha() else c if not c.isascii() else " " for c in text)
        data = re.sub(rb" +", b" ", b" " + kept.encode() + b" ")
        return [((data[i] << 16 | data[i + 1] << 8 | data[i + 2]) * 2654435761 % 2**32) >> 15 for i in range(len(data) - 2)]

    def normal(values):
        return [v / sum(values) for v in values]

    def softmax(logs):
        return normal([math.exp(x - max(logs)) for x in logs])

    declared = Counter(d for d, t, _ in rows if d and t is not None)
    languages = sorted(x for x, n in declared.items() if n >= 2)
    counts = {x: Counter(g for d, t, _ in rows if d == x for g in grams(t)) for x in languages}
    logs, gains, own = [], [], []
    for _, text, _ in rows:
        found = grams(text or "")
        if not found:
            logs.append([0.0] * len(languages)), gains.append(0.0), own.append([0.0] * len(languages))
            continue
        mean = [sum(math.log((counts[x][g] + 0.5) / (sum(counts[x].values()) + 2**16)) for g in found) / len(found) for x in languages]
        logs.append([m * min(len(found), 40) for m in mean]), gains.append(max(mean) + math.log(2**17)), own.append(softmax(logs[-1]))
    top = normal([1 + sum(o[k] for o in own) for k in range(len(languages))])

    def smooth(wanted, above):
        taken = [o for o, r in zip(own, rows) if wanted(r)]
        return [(sum(o[k] for o in taken) + 20 * a) / (sum(map(sum, taken)) + 20) for k, a in enumerate(above)]

    suffix = lambda host: host.rsplit(".", 1)[1] if host and "." in host else None
    out = []
    for (tag, _, host), log, gain in zip(rows, logs, gains):
        above = smooth(lambda r: suffix(r[2]) == suffix(host), top) if suffix(host) else top
        prior = smooth(lambda r: r[2] == host, above) if host else top
        says = [s / t for s, t in zip(smooth(lambda r: r[0] == tag, top), top)] if tag else [1.0] * len(top)
        posterior = softmax([x + math.log(p) + math.log(s) for x, p, s in zip(log, prior, says)])
        out.append((languages[posterior.index(max(posterior))], max(posterior), gain))
    return out


def test_posteriors_equal_those_by_hand(spark):
    rows = [*texts(12), ("de", WORDS["fr"], "www.site-fr.fr"), (None, "Le chat, 12 - la MAISON!", "new.fr"), ("xx", "été là ça", None),
            ("fr", "", "www.site-de.de"), (None, None, "archive"), ("en", "123 ...", None), (None, "der the le", "new.site-de.de"), *texts(1)]
    got, want = identify(spark, rows), by_hand(rows)
    for i, (best, confidence, gain) in enumerate(want):
        assert got[i][5] == best and abs(got[i][6] - confidence) < 1e-4 and abs(got[i][7] - gain) < 1e-4, (i, rows[i], got[i], want[i])
        assert got[i][8] == (got[i][6] >= 0.5 and got[i][7] >= 0.5)
