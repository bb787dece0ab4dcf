"""Licences, URLs and the pipeline against brute force."""

import math
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import decontaminate, licenses, line_dedup, near_dup, pieces, url_filter

SF = "/root/testdata/sf0.001"

FILES = [
    (1, "a/LICENSE", "Some words first\nReleased under the MIT License.\n"),
    (2, "a/b/x.py", "code code code\n"),
    (3, "a/b/y.py", "Licensed under the Apache License, Version 2.0.\nmore text here"),
    (4, "a/c/COPYING.txt", "This work is licensed under the GNU General Public License, version 3."),
    (5, "a/c/d/e/z.py", None),
    (6, "f/z.py", ""),
    (7, None, "nothing at all"),
    (8, "LICENSE", "the license of that"),
    (9, "g/notice", "Licensed under CC BY-NC 4.0.\nReleased under the MIT License."),
    (10, "g/h.py", "x"),
    (10, "g/h.py", "x"),
    (11, "w/x.py", "# code\n\nPermission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies.\n\nmore"),
    (12, "u/UNLICENSE", licenses.TEMPLATES[-1][1].replace(". ", ".\n\n")),
]


def brute_licenses(files):
    def words(t):
        t = re.sub("[A-Z]", lambda m: m[0].lower(), t)
        return [w for w in re.findall(r"[0-9A-Za-z\x80-\U0010ffff]+", t) if w not in licenses.STOP]

    templates = [(name, words(text)) for name, text in licenses.TEMPLATES]
    known = {w for _, t in templates for w in t} | {w for needs, against in licenses.RULES.values() for some in (*needs, against) for w in some}
    units, n = {}, 0
    for key, path, text in files:
        own = [x for x in (text or "").split("\n") if x.strip(" ")]
        own += [x for x in re.split(licenses.BLANK_LINES, text or "") if "\n" in x.strip("\n")]
        if path and path.rsplit("/", 1)[-1].split(".")[0].lower() in licenses.LICENCE_FILES:
            own.append(text or "")
        units[key, path] = [words(x) for x in own]
        n += len(own)
    df = {}
    for (key, path), own in units.items():
        times = sum(1 for f in files if f[:2] == (key, path))
        for u in own:
            for w in set(u) & known:
                df[w] = df.get(w, 0) + times

    def idf(w):
        return math.log((n + 1) / (df.get(w, 0) + 1)) + 1

    own = {}
    for k, us in units.items():
        best = None
        for u in us:
            found = []
            x = {w: u.count(w) * idf(w) for w in set(u) & known}
            norm = math.sqrt(sum(v * v for v in x.values()) + len(set(u) - known) * idf("") ** 2)
            for i, (name, t) in enumerate(templates):
                y = {w: t.count(w) * idf(w) for w in set(t)}
                score = round(sum(v * y.get(w, 0) for w, v in x.items()) / (norm or 1) / math.sqrt(sum(v * v for v in y.values())), 6)
                if score >= licenses.THRESHOLD:
                    found.append((-score, i, name))
            if not found:
                continue
            good = sorted(f for f in found if all(set(some) & set(u) for some in licenses.RULES.get(f[2], ((), ()))[0]) and not set(licenses.RULES.get(f[2], ((), ()))[1]) & set(u))
            others = [f for f in good if f[2] != good[0][2]]
            top = min(good or found)
            name = top[2] if good and (not others or others[0][0] - top[0] >= licenses.MARGIN) else "ambiguous"
            if best is None or top[:2] < best[0]:
                best = (top[:2], name, -top[0])
        own[k] = best and best[1:]
    out = {}
    for k, got in own.items():
        path, found = k[1], None
        if got is None and path:
            folder = path.rpartition("/")[0]
            while found is None:
                at = folder + "/" if folder else ""
                near = [(-own[j][1], j[1], own[j]) for j in own if j[1] and own[j] and j[1].rpartition("/")[0] == folder and j[1][len(at) :].split(".")[0].lower() in licenses.LICENCE_FILES]
                if near:
                    found = (min(near)[1], min(near)[2])
                if not folder:
                    break
                folder = folder.rpartition("/")[0]
        out[k] = (got[0], got[1], "own", None) if got else (found[1][0], found[1][1], "inherited", found[0]) if found else (None, None, "none", None)
    return out


def test_licenses(spark):
    files = spark.createDataFrame([(*f, "x", 1.0) for f in FILES], "key bigint, path string, text string, license string, score double")
    got = licenses.scan(files).collect()
    want = brute_licenses(FILES)
    assert len(got) == len(FILES)
    for r in got:
        name, score, how, source = want[r["key"], r["path"]]
        assert (r["license"], r["how"], r["source"]) == (name, how, source), r
        assert score is None and r["score"] is None or abs(r["score"] - score) < 2e-6
    assert {r["key"]: r["how"] for r in got}[2] == "inherited"
    assert licenses.scan(files.limit(0)).count() == 0


LOOK_ALIKES = {
    "This program is free software; you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation; either version 2 of the License, or\n(at your option) any later version.": "GPL-2.0",
    "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.": "GPL-3.0",
    "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU Affero General Public License as\npublished by the Free Software Foundation, either version 3 of the\nLicense, or (at your option) any later version.": "AGPL-3.0",
    "This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public\nLicense as published by the Free Software Foundation; either\nversion 2.1 of the License, or (at your option) any later version.": "LGPL-2.1",
    "This library is free software: you can redistribute it and/or modify\nit under the terms of the GNU Lesser General Public License, version 3 of the License\nas published by the Free Software Foundation": "LGPL-3.0",
    "GNU GENERAL PUBLIC LICENSE\nVersion 2, June 1991": "GPL-2.0",
    "GNU GENERAL PUBLIC LICENSE\nVersion 7, May 2031": "ambiguous",
    "GNU General Public License, version 2 or version 3.\nThis work is licensed under the": "ambiguous",
    "This work is licensed under a Creative Commons Attribution 4.0 International License.": "CC-BY-4.0",
    "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.": "CC-BY-SA-4.0",
    "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.": "CC-BY-NC-ND-4.0",
    "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.": "CC-BY-NC-SA-4.0",
    "Licensed under CC BY-ND 4.0.": "CC-BY-ND-4.0",
    "This work is licensed under a Creative Commons Attribution 3.0 International License.": "ambiguous",
    "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work under CC0.": "CC0-1.0",
    "Distributed under the Boost Software License, Version 1.0.": "BSL-1.0",
    "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0": "EPL-2.0",
    "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:\n1. Redistributions of source code must retain the above copyright notice, this\n   list of conditions and the following disclaimer.\n2. Redistributions in binary form must reproduce the above copyright notice,\n   this list of conditions and the following disclaimer in the documentation\n   and/or other materials provided with the distribution.": "BSD-2-Clause",
}


def test_licences_that_look_alike(spark):
    rows = [(i, f"d{i}/x.py", f"code\n\n{text}\n\nmore") for i, text in enumerate(LOOK_ALIKES)]
    got = {r["key"]: (r["license"], r["how"]) for r in licenses.scan(spark.createDataFrame(rows, "key bigint, path string, text string")).collect()}
    assert got == {i: (name, "own") for i, name in enumerate(LOOK_ALIKES.values())}


def test_every_licence_line_of_documents_is_found(spark):
    from tidemark.llm.licenses import op1_license_scan

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    marked = docs.where(F.col("text").rlike("MIT License|Apache License|General Public License|CC BY-NC")).select("doc_id")
    own = op1_license_scan(spark, "/root/testdata/sf0.01").where("how = 'own'").select("doc_id")
    assert marked.count() > 20 and sorted(r[0] for r in marked.collect()) == sorted(r[0] for r in own.collect())


def test_verdicts_on_linked_pages(spark):
    """Trust and distrust by power iteration over a random web, for pages that no rule covers."""
    import random

    import numpy as np

    r = random.Random(4)
    hosts = [f"h{i}.info" for i in range(14)] + ["a.com", "b.com", "c.net", "d.net", "e.org", "f.org"]
    paths = {"com": ["/en/", "/x"], "net": ["/de/", "/x"], "org": ["/es/", "/x"], "info": ["/x"]}
    rows = [(i, f"https://{h}{r.choice(paths[h[-4:].split('.')[-1]])}", "".join(f'<a href="//{r.choice(hosts)}/">' for _ in range(r.randint(0, 3)))) for i, h in enumerate(hosts * 3)]
    got = {x["page_id"]: x for x in url_filter.judged(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    links = {(got[i]["host"], d) for i, _, html in rows for d in re.findall(r'//([^/]*)/"', html) if d != got[i]["host"]}
    at = {h: i for i, h in enumerate(hosts)}

    def ranks(edges, verdict):
        n = len(hosts)
        share = np.array([np.mean([x["verdict"] == verdict and x["rule"] is not None for x in got.values() if x["host"] == h]) for h in hosts])
        share /= share.sum()
        move = np.zeros((n, n))
        for a, b in edges:
            move[at[b], at[a]] = 1
        degree = move.sum(axis=0)
        rank = share.copy()
        for _ in range(400):
            moved = 0.85 * move @ np.divide(rank, degree, out=np.zeros(n), where=degree > 0)
            rank = moved + share * (1 - moved.sum())
        return rank

    worse = ranks({(b, a) for a, b in links}, "block") - ranks(links, "allow")
    free = [x for x in got.values() if x["rule"] is None]
    assert {x["verdict"] for x in free} == {"allow", "block"}
    for x in free:
        if abs(worse[at[x["host"]]]) > 1e-4:
            assert x["verdict"] == ("block" if worse[at[x["host"]]] > 0 else "allow"), x


URLS = [
    (1, "http://A.Example.COM/en/7x?q", "", "a.example.com", "/en/7x", "example.com/en/7", "allow"),
    (2, "https://b.com/en/", "", "b.com", "/en/", "com/en/", "block"),
    (3, "https://b.com/EN/", "", "b.com", "/EN/", None, None),
    (4, "https://example.net/de/8", "", "example.net", "/de/8", "example.net/de/8", "block"),
    (5, "https://xexample.net/de/8", "", "xexample.net", "/de/8", "net/de/", "allow"),
    (6, "no scheme", "", "", "", None, "allow"),
    (7, None, None, "", "", None, "allow"),
    (8, "x://host#f", "", "host", "", None, "allow"),
    (9, "https://org/es/1", "", "org", "/es/1", "org/es/", "block"),
    (10, "https://bad.org/es/1", "", "bad.org", "/es/1", "org/es/", "block"),
    (11, "https://near.info/", '<a href="https://bad.org/x">', "near.info", "/", None, "block"),
    (12, "https://good.net/de/", "<A HREF='//friend.info/y'><a href=/local>", "good.net", "/de/", "net/de/", "allow"),
    (13, "https://friend.info/", '<a href="http://bad.org/">', "friend.info", "/", None, None),
]


def test_url_rules_and_links(spark):
    pages = spark.createDataFrame([(u[0], u[1], u[2], 1, "v") for u in URLS], "page_id bigint, url string, html string, rank int, verdict string")
    got = {r["page_id"]: r for r in url_filter.judged(pages).collect()}
    for page, _, _, host, path, rule, verdict in URLS:
        r = got[page]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == verdict if verdict else r["verdict"] in ("allow", "block")
    assert url_filter.judged(pages.limit(0)).count() == 0


def test_ranks(spark):
    edges = [("s", "a"), ("a", "b"), ("b", "a"), ("a", "c"), ("d", "s")]
    got = {r["host"]: r["rank"] for r in url_filter.spread(spark.createDataFrame(edges, "src string, dst string"), spark.createDataFrame([("s",)], "host string")).collect()}
    rank = {"s": 1.0}
    for _ in range(60):
        new = dict.fromkeys("sabc", 0.0)
        for u, v in edges:
            new[v] = new.get(v, 0) + 0.85 * rank.get(u, 0) / sum(1 for e in edges if e[0] == u)
        new["s"] += 1 - sum(new.values())
        rank = new
    assert set(got) == set("sabc") and all(abs(got[h] - rank[h]) < 1e-6 for h in got)


def brute_ranks(edges, weights):
    total = sum(weights.values())
    rank = {h: w / total for h, w in weights.items()}
    for _ in range(200):
        new = {}
        for u, v in edges:
            new[v] = new.get(v, 0) + 0.85 * rank.get(u, 0) / sum(1 for e in edges if e[0] == u)
        left = 1 - sum(new.values())
        for h, w in weights.items():
            new[h] = new.get(h, 0) + left * w / total
        rank = new
    return rank


def test_url_hosts_with_mixed_pages_are_seeds(spark):
    pages = [("bad.com", "/en/1", ""), ("bad.com", "/x", ""), ("near.info", "/", '<a href="http://bad.com/">'), ("good.net", "/de/", '<a href="//friend.info/">'), ("good.net", "/q", ""), ("friend.info", "/", '<a href="http://worse.org/">'), ("worse.org", "/es/1", ""), ("worse.org", "/es/2", ""), ("worse.org", "/", "")]
    pages += [("example.net", "/de/8", ""), ("example.net", "/de/1", '<a href="http://near.info/">'), ("example.net", "/z", ""), ("alone.info", "/", "")]
    df = spark.createDataFrame([(i, f"http://{h}{p}", html) for i, (h, p, html) in enumerate(pages)], "page_id bigint, url string, html string")
    got = {r["page_id"]: r for r in url_filter.judged(df).collect()}
    edges = [("near.info", "bad.com"), ("good.net", "friend.info"), ("friend.info", "worse.org"), ("example.net", "near.info")]
    trust = brute_ranks(edges, {"good.net": 1 / 2, "example.net": 1 / 3})
    distrust = brute_ranks([(v, u) for u, v in edges], {"bad.com": 1 / 2, "worse.org": 2 / 3, "example.net": 1 / 3})
    for i, (host, _, _) in enumerate(pages):
        if got[i]["rule"] is None:
            assert got[i]["verdict"] == ("block" if distrust.get(host, 0) > trust.get(host, 0) else "allow"), host
    assert [got[i]["verdict"] for i in (1, 4, 8, 12)] == ["block", "allow", "block", "allow"]


def test_pipeline(spark, tmp_path):
    """Each stage's result follows from its input by the operators that other tests hold against brute force."""
    docs, columns = spark.read.parquet(f"{SF}/documents.parquet"), None
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(i))
        stage(spark, docs, SF).write.parquet(path)
        out = spark.read.parquet(path)
        columns = columns or docs.columns
        if name != "tokenised":
            assert out.columns == columns and out.join(docs, "doc_id", "left_anti").count() == 0
        if name == "language":
            good = spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").select("doc_id")
            lost = docs.where("text is not null").join(out, "doc_id", "left_anti")
            assert lost.join(good, "doc_id").count() == 0  # junk goes, documents labelled good stay
            assert 0 < lost.count() <= 0.05 * docs.count()
        if name == "lines":
            drops = {r["doc_id"]: set(r["drops"]) for r in line_dedup.duplicate_lines(docs).collect()}
            before = {r["doc_id"]: r["text"] for r in docs.collect()}
            for r in out.collect():
                want = "\n".join(x for p, x in enumerate(before[r["doc_id"]].split("\n")) if p not in drops.get(r["doc_id"], ()))
                assert r["text"] == want and r["n_chars"] == len(want)
        if name == "near_duplicates":
            kept = {r["doc_id"] for r in near_dup.near_duplicates(docs, 2, 80).collect() if r["kept"]}
            assert {r["doc_id"] for r in out.collect()} == kept
        if name == "decontaminated":
            bad = {r["doc_id"] for r in decontaminate.contamination(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).collect() if r["contaminated"]}
            assert {r["doc_id"] for r in out.collect()} == {r["doc_id"] for r in docs.collect()} - bad
        if name == "tokenised":
            model = pieces.Model(pieces.model_path())
            texts = {r["doc_id"]: r["text"] for r in docs.collect()}
            assert all(r["same"] and r["n_pieces"] == len(model.sp.encode(texts[r["doc_id"]])) for r in out.collect())
        docs = out
    assert corpus_pipeline.run(spark, SF).count() == docs.count()


@pytest.mark.parametrize("name", [s[0] for s in corpus_pipeline.STAGES])
def test_stages_of_nothing(spark, name):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    assert dict(corpus_pipeline.STAGES)[name](spark, docs, SF).count() == 0
