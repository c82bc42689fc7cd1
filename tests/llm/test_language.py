import math
import random
from collections import defaultdict

import numpy as np
import pytest
from conftest import *  # noqa: F403
from pyspark.sql import functions as F

from variantrank.llm import language_id as lid

SYLLABLES = {"en": "th sh ing ed er ou wh ly".split(), "de": "sch ung keit ü ß ein ver ge".split(), "fr": "eau é aux ç tion eux oi ment".split()}


def text(lang, seed, n=12):
    pick = random.Random(seed)
    return " ".join("".join(pick.choice(SYLLABLES[lang]) for _ in range(pick.randint(1, 3))) for _ in range(n))


def rows():
    out = []
    for i in range(90):
        lang = ("en", "de", "fr")[i % 3]
        out.append((i, text(lang, i), lang if i % 10 else "en", f"https://www.site{i % 3}.{'de' if lang == 'de' else 'com'}/x"))
    out += [(i, text("en", i), "en", None) for i in range(300, 320)]
    out += [(200, None, None, "https://www.site1.de/y"), (201, "", "de", None), (202, None, None, None), (203, "th", "xx", "no address")]
    return out + [(204, text("fr", 1), "FR-ca", "//site2.com:80/"), (None, None, None, None), (0, text("en", 0), "en", "https://www.site0.com/x")]


def brute(rows, options=lid.Options()):
    """The same posterior by plain loops."""
    langs = ["de", "en", "fr"]
    told = lambda d: d.split("-")[0].lower() if d else None
    counts = np.full((3, lid.BUCKETS), 0.5)
    for _, t, d, _ in rows:
        if told(d) in langs:
            for b in lid.trigram_buckets(t):
                counts[langs.index(told(d)), b] += 1
    model = np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)
    ll, q = [], []
    for _, t, _, _ in rows:
        b = lid.trigram_buckets(t)
        x = model[:, b].mean(axis=1, dtype=np.float64) * min(options.text_weight, len(b)) if len(b) else np.zeros(3)
        e = np.exp(x - x.max())
        ll.append(x)
        q.append(e / e.sum())
    world = np.sum(q, axis=0) + 1
    world /= world.sum()
    host = [a.split("//")[1].split("/")[0].split(":")[0] if a and "//" in a else None for _, _, _, a in rows]
    said = [None if told(d) is None else told(d) if told(d) in langs else "" for _, _, d, _ in rows]
    confusion = np.array([np.sum([x for x, s in zip(q, said, strict=True) if s == k] or [np.zeros(3)], axis=0) for k in [*langs, ""]]) + 0.5
    confusion = np.log(confusion / confusion.sum(axis=0))
    w, out = options.host_weight, []

    def mean(key, value):
        own = [x for x, h in zip(q, host, strict=True) if h and key(h) == value]
        return (np.sum(own, axis=0) + w * world) / (len(own) + w)

    for i, (key, _, _, _) in enumerate(rows):
        logs = ll[i].copy()
        if host[i]:
            same = [x for x, h in zip(q, host, strict=True) if h == host[i]]
            domain = lambda h: ".".join(h.split(".")[-2:])
            prior = (np.maximum(np.sum(same, axis=0) - q[i], 0) + w * mean(domain, domain(host[i]))) / (len(same) - 1 + w)
            suffix = lambda h: h.split(".")[-1]
            logs += np.log(prior) + np.log(mean(suffix, suffix(host[i]))) - np.log(world)
        else:
            logs += np.log(world)
        if said[i] is not None:
            logs += confusion[[*langs, ""].index(said[i])]
        p = np.exp(logs - logs.max())
        out.append((key, langs[int(np.argmax(p))], float(p.max() / p.sum())))
    return out


def frame(spark, data):
    df = spark.createDataFrame([(*r, "x", "x", "x") for r in data], "id long, body string, mark string, url string, host string, ll string, lang string")
    return lid.evidence_of(df, "id", "body", F.col("mark"), address=F.col("url"))


@pytest.mark.parametrize("broadcast", [50_000, 0])
def test_posterior_equals_brute_force(spark, broadcast):
    got = lid.identify(frame(spark, rows()), lid.Options(broadcast_hosts=broadcast)).collect()
    order = lambda x: (x[0] is None, x[0] or 0, x[1])
    want = sorted(brute(rows()), key=order)
    for (i, lang, p), r in zip(want, sorted(got, key=order), strict=True):
        assert (r.id, r.lang) == (i, lang)
        assert math.isclose(r.probability, p, rel_tol=1e-6)
        assert r.kept == (p >= 0.5)


def test_evidence_beyond_text(spark):
    """A host known for one language decides where the text says nothing; careless declarations do not win over text."""
    got = {r.id: r for r in lid.identify(frame(spark, rows())).collect() if r.id is not None}
    assert got[200].lang == "de" and got[201].lang == "de"
    assert all(got[i].lang == ("en", "de", "fr")[i % 3] for i in range(90))


def test_odd_and_empty(odd, none):
    rows = lid.evidence_of(odd, "doc_id", "text", F.col("lang"), host=F.col("source"))
    got = lid.identify(rows).collect()
    assert len(got) == odd.count()
    by_id = defaultdict(set)
    for r in got:
        by_id[r.id].add((r.lang, round(r.probability, 9)))
    assert len(by_id[105]) == 1
    assert lid.identify(lid.evidence_of(none, "doc_id", "text", F.col("lang"), host=F.col("source"))).count() == 0
    bare = lid.identify(rows.withColumn("declared", F.lit(None).cast("string"))).collect()
    assert {(r.lang, r.probability, r.kept) for r in bare} == {(None, 0.0, False)}


def strange(seed, n=60):
    """Texts of no modelled language: Cyrillic, Greek, Han, letters and digits at random."""
    pick = random.Random(seed)
    letters = ["абвгдежзиклмнопрстуфхцчшыьэюя", "αβγδεζηθικλμνξοπρστυφχψω", "".join(map(chr, range(0x4E00, 0x5200))), "abcdefghijklmnopqrstuvwxyz0123456789"][seed % 4]
    return " ".join("".join(pick.choice(letters) for _ in range(pick.randint(2, 9))) for _ in range(n))


@pytest.mark.parametrize("langs", [("en", "de"), ("en", "de", "fr")])
def test_no_language_and_unmodelled_ones_are_not_kept(spark, langs):
    data = [(i, text(langs[i % len(langs)], i, 60), langs[i % len(langs)], f"https://www.site{i % 3}.com/x") for i in range(900)]
    data += [(1000 + i, strange(i), "en" if i < 4 else None, f"https://www.site{i % 3}.com/x") for i in range(40)]
    data += [(2000 + i, strange(i, 3000), "ru", None) for i in range(4)]
    for r in lid.identify(frame(spark, data)).collect():
        assert r.kept == (r.id < 1000), r
        assert (r.lang == langs[r.id % len(langs)] and r.probability > 0.99) if r.kept else (r.lang is None and r.probability < 0.01), r


def test_every_declared_language_has_a_model(spark):
    """Over 64 languages, each with far less than a thousandth of the rows."""
    pick, syllables = random.Random(7), {}
    for k in range(70):
        syllables[f"l{k:02}"] = ["".join(pick.choice("abcdefghijklmnopqrstuvwxyzäöüéèñçßøå") for _ in range(3)) for _ in range(12)]
    data = [(i, text("en", i % 40, 4), "en", None) for i in range(7500)]
    for k, (lang, parts) in enumerate(syllables.items()):
        data += [(10_000 + 6 * k + j, " ".join(pick.choice(parts) + pick.choice(parts) for _ in range(60)), lang, None) for j in range(6)]
    rows = frame(spark, data)
    assert lid.languages(rows, lid.Options()) == ["en", *sorted(syllables)]
    got = {r.id: r for r in lid.identify(rows).where("id >= 10000").collect()}
    assert all(got[i].lang == lang and got[i].kept for i, _, lang, _ in data if i >= 10_000)
