import re

from conftest import *  # noqa: F403

from variantrank.llm import license_scan

PHRASES = {"cc-by": "cc by", "gpl": "general public license", "reserved": "all rights reserved"}


def brute(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    places, labels = [], set()
    for label, phrase in PHRASES.items():
        own = phrase.split()
        at = [i for i in range(len(words)) if words[i : i + len(own)] == own]
        places += at
        labels |= {label} if at else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_scan(spark):
    lead = prose(3, 40)  # noqa: F405
    texts = [
        f"{lead} All Rights   reserved. all-rights_reserved ALL RIGHTS RESERVED",
        f"{lead} Licensed under the Apache License,\n# Version 2.0 (the License)",
        f"{lead} licensed under the Apache licence, some day",
        f"Licensed under CC BY-NC 4.0. {lead} cc by cc cc by",
        "This work is licensed under the GNU General Public License, version 3.",
        "GNU Lesser General Public License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
        "éCC BY ccé by cc byé", "by cc", "rights reserved all rights", "", None, prose(9, 20_000),  # noqa: F405
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in license_scan.scan(df).collect()}
    for i, text in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(text)
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
    assert [got[i].labels for i in range(7)] == ["reserved", "apache-2.0", "", "cc-by,cc-by-nc-4.0", "gpl,gpl-3.0", "gpl,lgpl", "mit"]


def test_odd_and_empty(odd, none, odd_rows):
    assert license_scan.scan(odd).count() == len(odd_rows)
    assert license_scan.scan(none).count() == 0
