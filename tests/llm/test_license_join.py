import random
import re
import textwrap

from stratum.llm import license_join as L

PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(text):
    words = WORD.findall(lower(text))
    at = [(i, label) for phrase, label in PHRASES.items() for i in range(len(words))
          if words[i:i + len(phrase.split())] == phrase.split()]
    found = {}
    for line in lower(text).split("\n"):
        have = set(WORD.findall(line))
        for label, notice in L.TEMPLATES:
            want = set(WORD.findall(notice))
            share = len(want & have) / len(want)
            if len(want & have) >= L.THRESHOLD * len(want) - 1e-9:
                found[label] = max(found.get(label, 0.0), share)
    base = {label for _, label in at}
    starts = [i for i, _ in at]
    return (len(words), len(at), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | set(found))), 1.0 if at else max(found.values(), default=0.0))


def run(docs, **kw):
    return [(r.id, *tuple(r)[1:]) for r in L.digests(L.find_licenses(docs, **kw)).collect()]


def test_table(documents, texts):
    got = {r[0]: r[1:] for r in run(documents)}
    assert got == {i: brute(t) for i, t in texts.items()}
    assert sum(v[1] > 0 for v in got.values()) > 10


def test_filters_lose_nothing():
    """Every block against every template, in both orders of the words."""
    notices = [n for _, n in L.TEMPLATES]
    lines = notices + [" ".join(n.split()[i:]) for n in notices for i in range(1, 6)] + [
        " ".join(n.split()[:-i]) + " other words" for n in notices for i in range(1, 6)]
    for frequency in ({}, {w: k for k, w in enumerate(b"license the a under of".split())}):
        for threshold in (0.5, 0.8, 0.9, 1.0):
            matcher = L.Matcher(L.TEMPLATES, frequency, threshold)
            for line in lines:
                have, want = set(L.fold(line).split()), {}
                for label, notice in L.TEMPLATES:
                    template = set(L.fold(notice).split())
                    if len(template & have) >= threshold * len(template) - 1e-9:
                        want[label] = max(want.get(label, 0), len(template & have) / len(template))
                assert matcher.match(have) == want


def test_separators_and_places():
    base = L.base_matches(L.fold("x CC-BY/CC\nBY ccby GNU  general\tPublic License éMIT LICENSE mit license"))
    assert (base.starts, sorted(base.labels)) == ([6, 1, 3, 12], ["cc-by", "gpl", "mit"])


def test_wrapped_notices_and_one_long_line(spark):
    """Every template in a comment, hard-wrapped at any width; and all its words
    on one line, too far apart to be a notice."""
    rows, want = [], {}
    for label, notice in L.TEMPLATES:
        for width in (16, 40, 76):
            text = "x = 1\n/*\n * " + "\n * ".join(textwrap.wrap(notice, width)) + "\n */\ny = 2"
            want[len(rows)] = label
            rows.append((len(rows), text))
    words = sorted({w for _, n in L.TEMPLATES for w in n.split()})
    rows.append((len(rows), (" pad" * 30).join(words)))
    got = {r[0]: r for r in run(spark.createDataFrame(rows, "doc_id bigint, text string"))}
    assert all(label in got[i][6].split(",") for i, label in want.items())
    assert got[len(rows) - 1][6:] == ("", 0.0)


def test_every_block_counts():
    """Sliding counts against each window on its own."""
    matcher, rng = L.Matcher(L.TEMPLATES, {}, L.THRESHOLD), random.Random(3)
    found = 0
    for _ in range(400):
        notice = L.fold(rng.choice(L.TEMPLATES)[1]).split()
        words = rng.choices(notice, k=rng.randrange(30)) + notice + rng.choices(notice, k=9)
        del words[rng.randrange(len(words))]
        words.insert(rng.randrange(len(words)), b"pad")
        want = {}
        for label, n in L.TEMPLATES:
            size, template = len(L.fold(n).split()), set(L.fold(n).split())
            for at in range(max(1, len(words) - size + 1)):
                share = len(template & set(words[at:at + size])) / len(template)
                if share >= L.THRESHOLD - 1e-9:
                    want[label] = max(want.get(label, 0.0), share)
        assert matcher.match_text(words) == want
        found += bool(want)
    assert found > 100


def labels(text):
    return [(b.label, b.containment) for b in L.reported(L.Matcher(L.TEMPLATES, {}, L.THRESHOLD).blocks(L.fold(text).split()))]


def test_notices_of_one_family_are_told_apart():
    lgpl = ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
            "General Public License as published by the Free Software Foundation")
    assert labels(lgpl) == [("lgpl", 1.0)]
    assert labels(lgpl.replace("library", "program").replace("Lesser ", "")) == [("gpl", 1.0)]
    assert labels(lgpl.replace("library", "program").replace("Lesser", "Affero")) == [("agpl", 1.0)]
    isc = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
           "granted, provided that the above copyright notice and this permission notice appear in all copies.")
    assert labels(isc) == [("isc", 1.0)]
    cc0 = ("To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
           "this work.")
    assert labels(cc0) == [("cc0", 1.0)]
    assert labels("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.") == [("cc-by-sa", 1.0)]
    for label, notice in L.TEMPLATES:
        assert labels(notice)[0][0] == label


def test_places_of_blocks():
    """Two notices far apart in a long text, one of them twice, each found where it stands."""
    rng = random.Random(5)
    pad = lambda n: [f"w{rng.randrange(300)}" for _ in range(n)]
    mit = "released under the mit license".split()
    mpl = L.fold(dict(L.TEMPLATES)["mpl"]).decode().split()
    words = pad(4000) + mit + pad(3000) + mpl + pad(500) + mit + pad(10)
    found = L.reported(L.Matcher(L.TEMPLATES, {}, L.THRESHOLD).blocks([w.encode() for w in words]))
    assert [(b.label, b.start, b.end) for b in found] == [
        ("mit", 4000, 4005), ("mpl", 7005, 7005 + len(mpl)), ("mit", 7505 + len(mpl), 7510 + len(mpl))]


def test_blocks_against_every_window():
    """Prefix places decide which windows are counted, and none that matches is missed."""
    rng = random.Random(8)
    vocabulary = sorted({w for _, n in L.TEMPLATES[:12] for w in L.fold(n).split()})
    for order in ({}, {w: rng.randrange(100) for w in vocabulary}):
        for _ in range(150):
            threshold = rng.choice([0.6, 0.8, 0.9])
            matcher = L.Matcher(L.TEMPLATES, order, threshold)
            label, notice = rng.choice(L.TEMPLATES)
            words = rng.choices(vocabulary, k=rng.randrange(60)) + L.fold(notice).split() + rng.choices(vocabulary, k=rng.randrange(60))
            for _ in range(rng.randrange(4)):
                words[rng.randrange(len(words))] = b"pad"
            want = {}
            for of, n in L.TEMPLATES:
                size, template = len(L.fold(n).split()), set(L.fold(n).split())
                for at in range(max(1, len(words) - size + 1)):
                    share = len(template & set(words[at:at + size])) / len(template)
                    if share >= threshold - 1e-9:
                        want[of] = max(want.get(of, 0.0), share)
            assert matcher.match_text(words) == want


def test_odd_rows(odd_docs, no_docs):
    got = sorted(run(odd_docs), key=str)
    assert got == sorted(((r.doc_id, *brute(r.text)) for r in odd_docs.collect()), key=str)
    assert run(no_docs) == []
