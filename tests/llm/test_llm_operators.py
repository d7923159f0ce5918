"""Edge cases and brute-force comparisons of the training-data operators, on small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

import corpus_pipeline
from sentiscope.llm import (decontaminate, html_text, interpolated_lm, licenses, mixing, near_duplicates, pii, quality,
                            queries, secrets, url_filter)

SCHEMA = "doc_id long, text string, source string, size int, kept string, `row` string, measures int, _key int"
WORDS = "The little boat of the old harbour was painted in red and it lay in the quiet water for a long summer".split()


def prose(n, seed=0):
    return " ".join(f"{WORDS[(i * 7 + seed) % len(WORDS)]}" if i % 3 else f"word{seed}x{i}" for i in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    base = prose(200, 1)
    rows = [
        (0, None, "a", 1, "x", "r", 1, 1), (1, "", "a", 1, "x", "r", 1, 1), (2, " \n\t ", None, 1, "x", "r", 1, 1),
        (3, "tiny", "b", 1, "x", "r", 1, 1), (4, base, "b", 1, "x", "r", 1, 1), (5, base, "b", 1, "x", "r", 1, 1),
        (5, base, "b", 1, "x", "r", 1, 1), (6, base.replace("word1x90", "changed"), "c", 1, "x", "r", 1, 1),
        (7, prose(200, 2), "c", 1, None, "r", None, 1), (None, prose(120, 3), "c", 1, "x", "r", 1, 1),
        (8, "same words again " * 100, "a", 1, "x", "r", 1, 1), (9, prose(30_000, 4), "a", 1, "x", "r", 1, 1),
        (10, 'a password = "hunter22" in prose', "a", 1, "x", "r", 1, 1),
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def test_empty_tables(spark, empty):
    items = spark.createDataFrame([], "item_id long, text string")
    assert mixing.mix(empty).count() == 0
    assert quality.keep_good(empty).count() == 0
    assert near_duplicates.near_duplicate_classes(empty).count() == 0
    assert near_duplicates.drop_near_duplicates(empty).columns == empty.columns
    assert decontaminate.remove_contaminated(empty, items).count() == 0
    assert pii.replace_personal_data(empty).count() == 0
    assert licenses.find_licenses(empty, licenses.known_digests(spark)).count() == 0
    assert interpolated_lm.score_documents(empty).count() == 0
    assert secrets.mask_secrets(empty).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert url_filter.judge_urls(pages, url_filter.rule_table(spark)).count() == 0
    assert html_text.extract_main_text(pages).count() == 0


def test_mix_meets_targets(docs):
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count()
    assert sorted((r.doc_id or -1, r.taken) for r in rows) == sorted((r.doc_id or -1, r.taken) for r in mixing.mix(docs).collect())
    for source in {r.source for r in rows}:
        mine = [r for r in rows if r.source == source]
        assert all(0 <= r.taken <= 2 * r.size for r in mine)
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 1
        assert mine[0].target <= 2 * mine[0].source_size


def test_quality_against_python(docs):
    judged, m = quality.judge(docs)
    got = judged.select("text", *[judged[c].alias(f"out_{k}") for k, c in m.items()]).collect()
    for r in got:
        words = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
        hit = {p for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for p in range(i, i + 3)}
        assert (r.out_n_words, r.out_n_repeat_words) == (len(words), len(hit))
        assert r.out_base_failed == (len(words) < 50 or 100 * len(hit) > 50 * len(words))
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and 7 in [r.doc_id for r in kept.collect()]


def test_near_duplicates(docs):
    got = {(r.doc_id, r.class_id, r.class_size) for r in near_duplicates.near_duplicate_classes(docs).collect()}
    assert {(4, 4, 4), (5, 4, 4), (6, 4, 4), (7, 7, 1), (0, 0, 1), (1, 1, 1), (2, 2, 1), (3, 3, 1)} <= got
    left = [r.doc_id for r in near_duplicates.drop_near_duplicates(docs).collect()]
    assert left.count(4) == 1 and 5 not in left and 6 not in left and {0, 1, 2, 3, 7, 8, 9, None} <= set(left)


def test_dart_signatures_estimate_weighted_jaccard():
    import numpy as np

    rng = np.random.default_rng(1)
    element = rng.integers(1, 2**63, 400, dtype=np.uint64)
    weight = 1 + np.log(rng.integers(1, 9, 400))
    other = weight.copy()
    other[:120] = 1.0
    doc = np.repeat([0, 1], [400, 350])
    all_elements, all_weights = np.r_[element, element[:350]], np.r_[weight, other[:350]]
    s = near_duplicates.dart_signatures(doc, all_elements, all_weights, 2, 2000)
    want = np.minimum(weight[:350], other[:350]).sum() / (np.maximum(weight[:350], other[:350]).sum() + weight[350:].sum())
    assert abs((s[0] == s[1]).mean() - want) < 0.04


def test_decontamination_against_python(spark, docs):
    text = prose(200, 2).split()
    items = spark.createDataFrame([(1, " ".join(text[20:45])), (12, "Tiny!"), (2, None), (3, " "), (1, " ".join(text[20:45]))],
                                  "item_id long, text string")
    for words in (1_000_000, 10):  # one block, and several
        rows = {(r.doc_id, r.n_words): r for r in decontaminate.find_passages(docs, items, block_words=words).collect()}
        assert (rows[7, 200].n_hit, rows[7, 200]["items"]) == (25, ["1"])
        assert (rows[3, 1].n_hit, rows[3, 1]["items"]) == (1, ["12"])
        assert rows[0, 0].n_hit == 0
    left = decontaminate.remove_contaminated(docs, items)
    assert left.columns == docs.columns and left.count() == docs.count() - 2


def test_surrogates_are_distinct_and_consistent(spark):
    rows = [(1, "Mail ann.lee@mail.org or ANN.LEE@MAIL.ORG, call +1 (212) 555-0100.", 0), (2, "ann.lee@mail.org 4000123412341234", 0),
            (3, "From bob@mail.org at 10.1.2.3, Frau Anna Schmidt and Frau Schmidt", 0), (4, None, 0), (5, "plain", 0)]
    got = {r.doc_id: r for r in pii.replace_personal_data(spark.createDataFrame(rows, "doc_id int, text string, _cuts int")).collect()}
    assert [got[i].n_entities for i in range(1, 6)] == [3, 2, 4, 0, 0] and got[4].text is None and got[5].text == "plain"
    first, upper = re.findall(r"\S+@\S+\.(?:org|ORG)", got[1].text)
    assert upper == first.upper() and got[2].text.startswith(first) and first not in got[3].text
    assert re.search(r"\+1 \(\d{3}\) \d{3}-\d{4}\.", got[1].text) and "555-0100" not in got[1].text
    assert "Schmidt" not in got[3].text and got[3].text.count("Frau ") == 2


def test_licenses(spark, docs):
    text = dict((k, t) for k, t in licenses.KNOWN)["MIT"]
    rows = [(1, text.replace("<year> <holder>", "2020 Ann").upper()), (2, "Prose.\n  released under the MIT Licence\nmore"), (3, None), (4, "MIT")]
    got = licenses.find_licenses(spark.createDataFrame(rows, "doc_id int, text string"), licenses.known_digests(spark)).collect()
    assert sorted((r.doc_id, r.licenses, r.n_lines, r.whole) for r in got) == [
        (1, "MIT", 0, True), (2, "MIT", 1, False), (3, "", 0, False), (4, "", 0, False)]


def test_lm_against_python(docs):
    got = interpolated_lm.score_documents(docs, chunk_tokens=500, range_tokens=700).collect()
    assert len(got) == docs.count()
    texts = [(r.doc_id, (r.text or "").lower().split() + ["\n"]) for r in docs.collect()]
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in texts}
    count = Counter(w for i, t in texts if not held[i] for w in t)
    n, v = sum(count.values()), len(count)
    for i, t in texts:
        base = sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t)
        assert any(r.doc_id == i and r.n_tokens == len(t) and r.train_tokens == n and r.held_out == held[i]
                   and r.n_known == sum(count[w] > 0 for w in t) and math.isclose(r.base_score, base, rel_tol=1e-9)
                   and r.score < 0 for r in got)


def test_urls(spark):
    urls = ["http://a.example.net/en/x", "https://example.net/de", "http://b.org/fr/1", "http://b.org", "nothing", None,
            "HTTP://WWW.Example.COM/de/?q=/en/"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id int, url string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(pages, url_filter.rule_table(spark)).collect()}
    assert got == {0: ("a.example.net", "/en/x", "example.net/en/", "allow"), 1: ("example.net", "/de", "net/", "block"),
                   2: ("b.org", "/fr/1", "org/fr/", "allow"), 3: ("b.org", "", None, "allow"), 4: ("", "", None, "allow"),
                   5: ("", "", None, "allow"), 6: ("www.example.com", "/de/", "example.com/de/", "block")}


def test_secrets(spark):
    key = "Zx9" + "aB3/kQ7+" * 5
    texts = ['token = "abcdef12" é password: short', "token=token: abcdefg", "AKIA" + "A" * 16 + " then " + key, key + " alone",
             "f" * 24 + " user=ann at https://db.example.com/x", None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.doc_id: r for r in secrets.report(secrets.find_secrets(df)).collect()}
    assert got[0].spans == "assign:0:17" and got[0].n_assign == 1 and got[1].spans == ""
    assert got[2].spans == f"access:0:20,weak_secret:26:{26 + len(key)}" and got[2].n_access == 1
    assert got[3].spans == "" and got[4].spans.startswith("hex:0:24,weak_access:25:33,endpoint:37:")
    assert got[5].base_sha256 == hashlib.sha256(b"").hexdigest()
    masked = {r.doc_id: r.text for r in secrets.mask_secrets(df).collect()}
    assert masked[0] == '[SECRET]" é password: short' and masked[2] == "[SECRET] then [SECRET]" and masked[5] is None


def test_html():
    page = ('<html><head><title>T</title></head><body><header><h1>Site</h1></header><nav><ul><li>Menu</ul></nav>'
            '<div class="cookie-notice">We use cookies</div><article><h1>Title</h1><p>First &amp; long paragraph of the article, '
            'with many words<br>in it.<p>Be.</p><script>var x="</p>";</script><form><p>Sign up</p></form></article>'
            '<div id="comments"><p>A reader comment that is long enough to look like text.</p></div><footer>End</footer>')
    want = "Title\n\nFirst & long paragraph of the article, with many words in it.\n\nBe."
    assert html_text.main_text(page) == want
    assert html_text.main_text(page.replace("<article>", '<div id="content">').replace("</article>", "</div>")) == want
    assert html_text.main_text(None) == html_text.main_text("") == "" and html_text.main_text("plain <b>text</b> <br") == "plain text"


def test_registered():
    assert sorted({int(re.match(r"op(\d+)_", k)[1]) for k in queries.QUERIES}) == list(range(1, 14))
    assert len(corpus_pipeline.STAGES) == 5 and set(queries.ORACLES) <= set(queries.QUERIES)


def test_pipeline_stages(spark, docs, tmp_path):
    folder = str(tmp_path)
    docs.write.parquet(folder + "/documents.parquet")
    spark.createDataFrame([(1, " ".join(prose(200, 2).split()[20:45]))], "item_id long, text string").write.parquet(
        folder + "/benchmark.parquet")
    left = sorted((r.doc_id or -1) for r in corpus_pipeline.run(spark, folder).collect())
    assert set(left) <= {-1, 4, 9} and left


def test_near_duplicates_against_all_pairs(spark):
    """Many edited copies of one text, whose similarities spread widely: classes are those of an all-pairs search."""
    import random

    draw = random.Random(3)
    base = [f"w{draw.randrange(10**6)}" for _ in range(150)]
    texts = []
    for i in range(160):
        words = list(base)
        for at in draw.sample(range(150), draw.choice([1, 2, 3, 4, 6, 9])):
            words[at] = f"edit{i}x{at}"
        texts.append(" ".join(words))
    sets = [{tuple(w[j:j + 5]) for j in range(len(w) - 4)} for w in (t.split() for t in texts)]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) and root[i] != root[j]:
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in near_duplicates.near_duplicate_classes(frame).collect()}
    assert [got[i] for i in range(len(texts))] == root
    assert 1 < len(set(root)) < len(texts)


LONG = "A long paragraph of running text that goes on for many words and so has a high ratio of text to tags"


def test_html_clusters_choose_the_region_on_every_page():
    links = "".join(f'<li><a href="/{i}">Go {i}</a></li>' for i in range(6))
    teaser = f'<body><article><h2><a href="/x">More</a></h2></article><ul>{links}</ul><div class="story"><p>{LONG} one.</p><p>{LONG} two.</p></div></body>'
    assert html_text.main_text(teaser) == f"{LONG} one.\n\n{LONG} two."
    siblings = f"<body><ul>{links}</ul><article><p>{LONG} one.</p></article><article><p>{LONG} two.</p></article></body>"
    assert html_text.main_text(siblings) == f"{LONG} one.\n\n{LONG} two."


def test_html_short_parts_of_a_region_stay():
    parts = ("<ul><li>one</li><li>two</li></ul>", "<table><tr><td>one<td>two</table>", "<blockquote>one</blockquote>", "<section><p>one</p></section>")
    wanted = ("one\n\ntwo", "one two", "one", "one")
    for part, want in zip(parts, wanted, strict=True):
        page = f'<body><ul><li><a href="/">Go</a></li></ul><div class="story"><p>{LONG} one.</p>{part * 3}<p>{LONG} two.</p></div></body>'
        assert html_text.main_text(page) == "\n\n".join([f"{LONG} one.", *[want] * 3, f"{LONG} two."])


def test_html_hidden_elements_end():
    assert html_text.main_text(f"<html><head><title>T</title><body><p>{LONG}</p></body>") == LONG
    assert html_text.main_text(f"<html><head><meta charset=x><link rel=y><p>{LONG}</p>") == LONG
    assert html_text.main_text(f"<body><div><noscript>No script</div><p>{LONG}</p>") == LONG
    assert html_text.main_text(f"<body><article><div><svg><g>Drawing</div><p>{LONG}</p></article>") == LONG


def test_license_texts_and_headers(spark):
    full = {k: t for k, t in licenses.known_texts() if len(t) > 600}
    apache = [t for k, t in licenses.known_texts() if k == "Apache-2.0" and t.startswith("Licensed under the Apache License, Version 2.0 (the")][0]
    gnu = [t for k, t in licenses.known_texts() if k == "GPL-3.0-or-later"][0].replace(" you can", "\n# you can").replace(" as pub", "\n# as pub")
    rows = [(1, full["BSD-2-Clause"]), (2, "A file.\n\n" + full["BSD-3-Clause"] + "\nand code\n"), (3, "Copyright 2020 Ann\n\n" + full["ISC"]),
            (4, "/*\n * " + apache.replace(" you may", "\n * you may") + "\n *\n *   https://www.apache.org/licenses/LICENSE-2.0\n *\n * Unless\n */\ncode"),
            (5, "#!/bin/sh\n#\n# " + gnu + "\n#\n# rest\n"), (6, "Intro\n\n" + full["GPL-3.0-only"]), (7, full["MPL-2.0"].replace("\n\n", "\r\n\r\n")),
            (8, full["BSD-2-Clause"].replace("binary form must", "binary form should")), (9, full["Apache-2.0"])]
    got = licenses.find_licenses(spark.createDataFrame(rows, "doc_id int, text string"), licenses.known_digests(spark)).collect()
    assert {r.doc_id: (r.licenses, r.whole) for r in got} == {
        1: ("BSD-2-Clause", True), 2: ("BSD-3-Clause", False), 3: ("ISC", True), 4: ("Apache-2.0", False), 5: ("GPL-3.0-or-later", False),
        6: ("GPL-3.0-only", False), 7: ("MPL-2.0", True), 8: ("", False), 9: ("Apache-2.0", True)}
    own = licenses.known_digests(spark, [("Own-1.0", "My own license.\n\nDo what you like.")])
    rows = [(1, "x\n\nMy own licence\n\n\nDo what you like!\n\ny")]
    assert licenses.find_licenses(spark.createDataFrame(rows, "doc_id int, text string"), own).first().licenses == "Own-1.0"


def test_known_licenses_contain_a_mark():
    assert all(re.search(f"(?i){licenses.MARKS}", t) for _, t in licenses.known_texts())


def test_surrogates_end_when_a_shape_is_used_up(spark):
    from pyspark.sql import functions as F

    shapes = [("email", "a@b.io"), ("email", "__@--.com"), ("person", "mr smith"), ("ipv4", "1.2.3.4"), ("phone", "2125550100"), ("card", "4000123412341234")]
    rows = spark.createDataFrame([(*shape, attempt) for shape in shapes for attempt in (0, 12)], "kind string, entity string, attempt int")
    new = {(r.entity, r.attempt): r.new for r in rows.withColumn("new", pii.surrogate(F.col("kind"), F.col("entity"), F.col("attempt"))).collect()}
    for _, entity in shapes[:3] + shapes[4:]:
        assert len(new[entity, 12]) > len(new[entity, 0])
    assert new["1.2.3.4", 12].count(".") > 3 and new["__@--.com", 0] != "__@--.com"
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = [("email", f"{x}@{y}.io") for x in letters for y in letters] + [("email", "__@--.com")]  # as many as there are short surrogates
    table = pii.surrogate_table(spark.createDataFrame(rows, "kind string, entity string")).collect()
    assert len({r.new for r in table}) == len(rows) == len(table) and not {r.new for r in table} & {e for _, e in rows}


def test_names_with_inner_capitals(spark):
    names = ["Mr O'Brien", "Mr O’Brien", "Mrs McDonald", "Mr Jean-Luc Picard", "Mr Smith", "Mr Smith"]
    text = "{} left. {} left. {} left. {} left. {} left. {}'s hat".format(*names)
    got = pii.replace_personal_data(spark.createDataFrame([(1, text)], "doc_id int, text string")).first()
    new = [part.strip() for part in got.text.split(" left.")]
    assert got.n_entities == 6 and new[0] == new[1] and new[5] == new[4] + "'s hat"
    assert not re.search("Brien|Donald|Luc|Picard|Smith", got.text)


def test_grown_digits_are_rendered(spark):
    from pyspark.sql import functions as F

    row = spark.createDataFrame([("phone", "(212) 555-0100", "98765432101")], "k string, m string, n string")
    assert row.select(pii.render(F.col("k"), F.col("m"), F.col("n"))).first()[0] == "(987) 654-32101"


def test_near_duplicates_of_repeated_texts(spark):
    """A text and its repetitions have nearly the same shingle set, whatever the counts."""
    times = (1, 2, 3, 5, 20, 60)
    rows = [(100 * i + r, " ".join([prose(400, 10 + i)] * r)) for i in range(4) for r in times]
    got = {r.doc_id: (r.class_id, r.class_size) for r in near_duplicates.near_duplicate_classes(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {100 * i + r: (100 * i + 1, len(times)) for i in range(4) for r in times}


def test_remaining_links_are_all_links_between_components(spark):
    """Members of buckets at every similarity around the threshold, none of them settled but with their pivots: no link is lost."""
    import random

    rng = random.Random(11)
    base, sets, buckets = [rng.randrange(2**62) for _ in range(120)], {}, {}
    for node in range(140):
        gone = rng.sample(range(120), rng.choice([0, 3, 7, 9, 11, 14, 30]))
        sets[node] = [x for i, x in enumerate(base) if i not in gone] + [rng.randrange(2**62) for _ in range(rng.choice([0, 5, 9, 12]))]
        buckets[node] = sorted(rng.sample(range(6), rng.choice([1, 2, 3])))

    def similar(a, b):
        x, y = set(sets[a]), set(sets[b])
        return len(x & y) >= 0.8 * len(x | y)

    component = {n: n for n in sets}

    def join(a, b):
        low, high = sorted((component[a], component[b]))
        component.update({n: low for n, c in component.items() if c == high})

    for bucket in range(6):
        inside = [n for n in sets if bucket in buckets[n]]
        for n in inside:
            if similar(n, min(inside)):
                join(n, min(inside))
    want = {(a, b) for a in sets for b in sets if a < b and component[a] != component[b] and set(buckets[a]) & set(buckets[b]) and similar(a, b)}
    member = spark.createDataFrame([(n, b) for n, bs in buckets.items() for b in bs], "node long, bucket long")
    labels = spark.createDataFrame(list(component.items()), "node long, component long")
    table = spark.createDataFrame(list(sets.items()), "node long, `set` array<long>")
    got = [tuple(r) for r in near_duplicates._remaining(member, labels, table, 0.8).collect()]
    assert len(got) == len(set(got)) and want <= set(got) and want
    assert all(component[a] != component[b] for a, b in got)
    linked = near_duplicates._linked(spark.createDataFrame(got, "a long, b long"), table, 0.8).collect()
    assert want <= {tuple(r) for r in linked} and len(linked) > 0.5 * len(got)


def test_no_link_of_the_given_documents_is_lost(spark):
    """Classes of all given documents against the all-pairs components of their shingle sets (by an index of shingles)."""
    from collections import defaultdict

    import pandas as pd

    frame = pd.read_parquet("/root/testdata/sf0.01/documents.parquet")
    sets = {}
    for doc, text in zip(frame.doc_id, frame.text):
        words = (text or "").lower().split()
        if words:
            sets[int(doc)] = frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4)))
    seen, root = defaultdict(list), {d: d for d in sets}

    def top(d):
        while root[d] != d:
            d = root[d]
        return d

    for d, s in sets.items():
        shared = Counter(o for shingle in s for o in seen[shingle])
        for other, n in shared.items():
            if n >= 0.8 * (len(s) + len(sets[other]) - n) and top(d) != top(other):
                root[max(top(d), top(other))] = min(top(d), top(other))
        for shingle in s:
            seen[shingle].append(d)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: r.class_id for r in near_duplicates.near_duplicate_classes(docs).where("component is not null").collect()}
    assert got == {d: top(d) for d in sets}


def test_classes_without_or_with_repeated_ids(spark):
    """Classes whose ids are all null, and classes that share an id, stay apart."""
    a, b, c, d = (prose(120, seed) for seed in (21, 22, 23, 24))
    rows = [(None, a), (None, a), (None, b), (None, b), (7, c), (7, c), (7, d), (8, d), (9, prose(120, 25)), (None, c), (None, None), (None, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    left = near_duplicates.drop_near_duplicates(frame).collect()
    assert sorted((r.doc_id or -1, r.text or "") for r in left) == sorted(
        [(-1, a), (-1, b), (7, c), (7, d), (9, prose(120, 25)), (-1, ""), (-1, "")])
    classes = near_duplicates.near_duplicate_classes(frame).where("component is not null").collect()
    assert len({r.component for r in classes}) == 5
    assert sorted((r.class_id or -1, r.class_size) for r in classes) == sorted([(-1, 2)] * 4 + [(7, 3)] * 3 + [(7, 2)] * 2 + [(9, 1)])


def test_pipeline_against_brute_force(spark, tmp_path):
    """run() against the same five stages by plain Python, the near duplicates by all pairs of shingle sets."""
    import random

    draw = random.Random(5)
    vocabulary = "".join(chr(97 + i) for i in range(26))
    def words(n):
        return ["".join(draw.choice(vocabulary) for _ in range(draw.randint(3, 9))) for _ in range(n)]
    stop = "the of and to in that is was".split()
    texts, ids = [], []
    for i in range(12):
        base = words(90 + i)  # the number of words tells the classes apart
        base[::6] = [draw.choice(stop) for _ in base[::6]]
        for copy in range(draw.choice([1, 2, 4])):
            edited = list(base)
            for at in draw.sample(range(90), draw.choice([0, 1, 2])):
                edited[at] = f"edit{vocabulary[copy]}"
            texts.append(" ".join(edited))
            ids.append(draw.choice([None, None, 3, 10 + len(ids)]))
    texts.append("too short"), ids.append(99)
    texts.append(" ".join([w for word in words(80) for w in (word, "the")] + ["password = hunter22222"])), ids.append(100)
    schema = "doc_id long, text string, source string"
    frame = spark.createDataFrame([(i, t, "s") for i, t in zip(ids, texts, strict=True)], schema)
    folder = str(tmp_path)
    frame.write.parquet(folder + "/documents.parquet")
    passage = " ".join(texts[0].split()[10:40])
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(folder + "/benchmark.parquet")

    kept = [(i, t) for i, t in zip(ids, texts, strict=True) if len(t.split()) >= 50]
    sets = [{tuple(w[j:j + 5]) for j in range(len(w) - 4)} for w in (t.lower().split() for _, t in kept)]
    root = list(range(len(kept)))
    for i in range(len(kept)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) and root[i] != root[j]:
                root = [min(root[i], root[j]) if r in (root[i], root[j]) else r for r in root]
    groups = {}
    for (i, t), r in zip(kept, root, strict=True):
        groups.setdefault(r, []).append((i is None, i or 0, hashlib.md5(t.encode()).hexdigest(), t))
    first = [(min(g)[1] or -1, min(g)[3]) for g in groups.values()]
    items = {tuple(passage.split()[j:j + 10]) for j in range(len(passage.split()) - 9)}
    clean = [(i, t) for i, t in first if not any(tuple(t.split()[j:j + 10]) in items for j in range(len(t.split()) - 9))]
    mixed = sorted((i, len(t.replace("password = hunter22222", secrets.MASK).split())) for i, t in clean)
    got = sorted((r.doc_id or -1, r["size"]) for r in corpus_pipeline.run(spark, folder).collect())
    assert got and len(first) < len(kept) < len(texts) and len(clean) < len(first) and got == mixed


def test_lm_weights_come_from_the_learning_fold_alone(spark):
    out = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    scores = []
    for text in (prose(80, 1), "quite other words " * 40):
        rows = [(i, text if i == out else prose(60 + i, i % 3)) for i in range(out + 12) if i == out or zlib.crc32(str(i).encode()) % 10]
        got = interpolated_lm.score_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        scores.append({r.doc_id: r.score for r in got if r.doc_id != out})
    assert scores[0] and scores[0].keys() == scores[1].keys()
    assert all(math.isclose(scores[0][i], scores[1][i], rel_tol=1e-9) for i in scores[0])


def test_repeated_window_of_a_very_long_text(spark):
    """All bits of a window's hash count: among millions of windows only the repeated one is found."""
    from pyspark.sql import functions as F

    n = 1_500_000
    text = F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.concat(F.lit("w"), i.cast("string"))),
                       F.lit("w7 w8 w9"))
    judged, m = quality.judge(spark.range(1).select(F.col("id").alias("doc_id"), text.alias("text")))
    row = judged.first()
    assert (row[m["n_words"]], row[m["n_repeat_words"]]) == (n + 3, 6)


def test_known_entries_without_a_license_word_are_found(spark):
    own = licenses.known_digests(spark, [("PD", "This work is in the public domain."), ("MIT-ish", "Permission is granted to all.")])
    rows = [(1, "Some prose.\nThis work is in the Public Domain!\nMore."), (2, "this work is in the public domain"), (3, "nothing here"),
            (4, "permission is granted to ALL"), (5, None), (5, None), (6, "")]
    got = {r.doc_id: (r.licenses, r.n_lines, r.whole) for r in licenses.find_licenses(spark.createDataFrame(rows, "doc_id long, text string"), own).collect()}
    assert got[1] == ("PD", 1, False) and got[2][0] == "PD" and got[2][2] and got[4][0] == "MIT-ish"
    assert got[3] == got[5] == got[6] == ("", 0, False)
    assert licenses.known_digests(spark).where("not marked").count() == 0


def test_surrogates_beside_a_column_of_the_same_name(spark):
    rows = [(1, "write to ann@example.org", 5, "x"), (1, "write to ann@example.org", 5, "x"), (2, None, None, None), (3, "no one", 1, "y")]
    got = pii.replace_personal_data(spark.createDataFrame(rows, "doc_id long, text string, n_entities int, _cuts string"))
    assert got.columns[:4] == ["doc_id", "text", "n_entities", "_cuts"] and len(got.columns) == 5
    assert sorted((r[0], r[4]) for r in got.collect()) == [(1, 1), (1, 1), (2, 0), (3, 0)]
