"""Operators 11 to 13 against brute force, and their edge cases."""

import gzip
import hashlib
import io
import zlib
from collections import Counter

import pyarrow as pa
import pytest

from sentiscope.llm import spelling, token_alignment, warc

DOCS = "doc_id long, text string, word string, n int, class int, block long, edit string"


# ------------------------------------------------------------------ operator 11
def brute_words(rows):
    counts = Counter()
    for doc, text in rows:
        run = ""
        for c in (text or "") + " ":
            if "A" <= c <= "Z" or "a" <= c <= "z" or "À" <= c <= "ÿ":
                run += c.lower() if c < "\x80" else c
            elif run:
                h = zlib.crc32(f"{'null' if doc is None else doc}:{run}".encode())
                counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % 199 == 0 else run] += 1
                run = ""
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_forms(counts):
    near = {w: [v for v in counts if v != w and one_edit(w, v)] for w in counts}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 5 * counts[w] else None
    out = set()
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return out


def forms_of(df):
    return [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]


LONG_WORD = "ab" * 3000


@pytest.fixture(scope="module")
def letters(spark):
    words = ["harbour", "harbours", "harbor", "arbour", "harbouur", "barbour", "Übung", "übungen", "ÜBUNGEN", "Übungen",
             "été", "mississippi", "missisippi", "misissippi", "aaaaaaa", "aaaaaaaa", "aaaaaa", "short", LONG_WORD,
             LONG_WORD + "b", LONG_WORD[:-1] + "c", "x×y÷zÿ"]
    rows = [(i, " ".join(w for k, w in enumerate(words) for _ in range(1 + (k * 7 + i) % (3 if k % 2 else 29))),
             "w", 1, 1, 1, "e") for i in range(12)]
    rows += [(None, "harbour harbour", "w", 1, 1, 1, "e"), (3, None, "w", 1, 1, 1, "e"), (3, "", None, None, None, None, None),
             rows[0], (99, "harbour," * 500, "w", 1, 1, 1, "e")]
    return spark.createDataFrame(rows, DOCS).repartition(4)


def variants(docs):
    return spelling.spelling_forms(spelling.vocabulary(spelling.with_slips(spelling.word_runs(docs))))


def test_variants_against_all_pairs(letters):
    want = brute_forms(brute_words([(r.doc_id, r.text) for r in letters.collect()]))
    got = forms_of(variants(letters))
    assert len(got) == len(want) and set(got) == want
    assert any(w[1] for w in want)


def test_variants_of_random_words_in_many_passes(spark, monkeypatch):
    import random

    rng = random.Random(5)
    counts = {"".join(rng.choice("abé") for _ in range(rng.randint(6, 9))): rng.choice([5, 6, 30, 200, 5000]) for _ in range(1500)}
    table = spark.createDataFrame([*counts.items(), (None, 9)], "word string, n int").repartition(5)
    want = brute_forms(counts)
    assert set(forms_of(spelling.spelling_forms(table))) == want
    # several slices per length, and a broadcast that holds two of them
    monkeypatch.setattr(spelling, "SLICE_WORDS", 100)
    monkeypatch.setattr(spelling, "BROADCAST_BYTES", 512)
    monkeypatch.setattr(spelling, "CHUNK", 700)
    assert set(forms_of(spelling.spelling_forms(table))) == want


def test_variants_roots_of_a_long_chain(spark):
    chain = {"abcdefgh"[:i] + "zzzzzz": 5 ** (9 - i) for i in range(9)}  # each word one letter from the next
    rows = forms_of(spelling.spelling_forms(spark.createDataFrame(list(chain.items()), "word string, n long")))
    assert {r[2] for r in rows} == {"zzzzzz"} and set(rows) == brute_forms(chain)


def test_variants_of_nothing(spark):
    none = spark.createDataFrame([], DOCS)
    assert variants(none).count() == 0
    assert variants(spark.createDataFrame([(1, "few", None, 1, 1, 1, None)], DOCS)).columns == [
        "word", "form", "root", "n", "n_near", "form_n"]


def test_filter_has_no_false_negatives():
    import numpy as np

    keys = spelling._word_keys([f"word{i:06d}" for i in range(5000)], 10)
    filled = spelling._Filter(1, 256)
    filled = spelling._Filter(1, 256, {0: filled.build(keys)})
    assert len(filled.hits(keys)) == 5000
    others = spelling._word_keys([f"nope{i:06d}" for i in range(5000)], 10)
    assert len(filled.hits(others)) < 100
    assert len(np.unique(keys)) == 5000


# ------------------------------------------------------------------ operator 12
PAGES = "page_id long, url string, html string, digest string, payload binary, head long, record_type string"


def brute_pages(rows):
    groups = {}
    for page_id, _, html in rows:
        body = (html or "").encode()
        if len(body) >= 1000:
            groups.setdefault(body, []).append(page_id)
    out = []
    for page_id, _, html in rows:
        body = (html or "").encode()
        head = max((i for i in groups.get(body, []) if i is not None), default=None)
        revisit = head is not None and page_id != head
        out.append((page_id, len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response",
                    head if revisit else None))
    return Counter(out)


@pytest.fixture(scope="module")
def pages(spark):
    big, odd = "<p>" + "copy é " * 300, "x" * 999
    rows = [(1, "http://a/1", big), (7, "http://a/7", big), (3, "http://a/3\r\nX: y", big), (7, "http://a/7", big), (None, None, big),
            (4, "u", odd), (5, "u", odd), (6, "u", odd + "x"), (8, "u", odd + "x"), (9, None, None), (10, "u", ""),
            (None, "u", "n" * 2000), (None, "u", "n" * 2000), (11, "u", "line\r\n\r\nWARC/1.1\r\nbreak" * 100),
            (12, "u", "long " * 500_000), (-5, "ü ", "\u0000\U0001f600" * 400)]
    return spark.createDataFrame([(*r, "d", b"p", 1, "t") for r in rows], PAGES).repartition(3)


def test_archives_round_trip(pages):
    want = brute_pages([(r.page_id, r.url, r.html) for r in pages.collect()])
    got = warc.archive_round_trip(pages)
    assert Counter(tuple(r) for r in got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()) == want


def test_archives_keep_payloads_and_places(spark, pages, tmp_dir):
    rows = warc.with_heads(pages)
    assert rows.count() == pages.count()
    whole = warc.write_archives(rows, f"{tmp_dir}/whole", archive_bytes=3000)
    assert whole.count() > rows.rdd.getNumPartitions() // 2  # small limit: several files per task
    assert sum(r.records for r in whole.collect()) == pages.count()
    kept = warc.normalise(whole, f"{tmp_dir}/records")
    index = warc.read_index(kept, tmp_dir)
    for row in index.limit(5).collect():  # every record inflates alone
        with open(row.path, "rb") as f:
            f.seek(row.offset)
            text = zlib.decompress(f.read(row.length), 31)
        assert text.startswith(b"WARC/1.1\r\n") and row.record_id.encode() in text
    for path in {r.path for r in kept.collect()}:  # and the file is a plain multi-member gzip
        with gzip.open(path) as f:
            assert f.read(8) == b"WARC/1.1"
    read = warc.read_records(index, tmp_dir).where("record_type = 'response'").collect()
    texts = Counter((r.html or "").encode() for r in pages.collect() if len((r.html or "").encode()) < 1000)
    assert texts <= Counter(bytes(r.payload) for r in read)
    # no line break of a url reaches the header
    assert not any("\r" in (r.url or "") for r in warc.read_records(index, tmp_dir).collect())


def test_archives_of_nothing(spark):
    assert warc.archive_round_trip(spark.createDataFrame([], PAGES)).count() == 0


def test_rewrite_takes_members_and_refuses_damage():
    record = warc._record("1", "u", b"some text", hashlib.sha1(b"some text").hexdigest(), None, "2000-01-01T00:00:00Z")
    members = gzip.compress(record) + gzip.compress(record * 2)  # a file that is members already, one of two records
    out = io.BytesIO()
    entries = list(warc.rewrite_stream(io.BytesIO(members), out))
    assert len(entries) == 3 and sum(e["length"] for e in entries) == len(out.getvalue())
    for e in entries:
        assert zlib.decompress(out.getvalue()[e["offset"]:e["offset"] + e["length"]], 31) == record
    for broken in (gzip.compress(record[:-20]), gzip.compress(b"no record\r\n"), gzip.compress(record)[:-30]):
        with pytest.raises((ValueError, EOFError)):
            list(warc.rewrite_stream(io.BytesIO(broken), io.BytesIO()))


# ------------------------------------------------------------------ operator 13
class Pieces:
    """A tokenizer for tests: cuts at the marks of the text's own pattern."""

    def __init__(self, cuts):
        self.cuts, self.tokens, self.ids = cuts, [], {}

    def encode(self, texts):
        out = []
        for t in texts:
            data, found, start = f" {t}".encode(), [], 0
            for end in [*self.cuts(data), len(data)]:
                if end > start:
                    piece = data[start:end]
                    if piece not in self.ids:
                        self.ids[piece] = len(self.tokens)
                        self.tokens.append(piece)
                    found.append(self.ids[piece])
                    start = end
            out.append(found)
        return out


def brute_groups(a, b, a_tokens, b_tokens):
    def ends(ids, tokens):
        at, out = 0, {}
        for k, i in enumerate(ids):
            at += len(tokens[i])
            out[at] = k
        return out

    ea, eb = ends(a, a_tokens), ends(b, b_tokens)
    groups, links, i, j = [], [], 0, 0
    for end in sorted(set(ea) & set(eb)):
        groups.append((a[i:ea[end] + 1], b[j:eb[end] + 1]))
        links.append((a[ea[end]], b[eb[end]]))
        i, j = ea[end] + 1, eb[end] + 1
    return groups, links


@pytest.mark.parametrize("seed", range(12))
def test_alignment_of_random_cuts(seed):
    import random

    rng = random.Random(seed)
    texts = ["".join(rng.choice("abc dé") for _ in range(rng.choice([1, 2, 7, 40, 700]))) for _ in range(30)] + [None, ""]
    density = rng.choice([0.02, 0.3, 0.9])
    first = Pieces(lambda d: [i for i in range(1, len(d)) if rng.random() < density])
    second = Pieces(lambda d: [i for i in range(1, len(d)) if rng.random() < 0.3])
    found = token_alignment.align_texts(texts, first, second)
    assert [len(x[0]) for x in found[-2:]] == [0, 0]
    for a, b, a_sizes, b_sizes in found[:-2]:
        groups, links = brute_groups(a.tolist(), b.tolist(), first.tokens, second.tokens)
        assert [len(g[0]) for g in groups] == a_sizes.tolist() and [len(g[1]) for g in groups] == b_sizes.tolist()
        got = token_alignment._links(a, b, a_sizes, b_sizes)
        assert [(x >> 32, x & (2**32 - 1)) for x in got.tolist()] == links


def test_alignment_without_shared_cuts_is_one_leaf():
    first, second = Pieces(lambda d: range(2, len(d), 2)), Pieces(lambda d: range(3, len(d) - 2, 2))
    (_, _, a_sizes, b_sizes), = token_alignment.align_texts(["x" * 200_001], first, second)
    assert len(a_sizes) == len(b_sizes) == 1


@pytest.fixture(scope="module")
def multilingual(spark):
    texts = ["The harbour was quiet.", "Où était-elle ? Ça va très bien", "naïve café ▁ block", "<|endoftext|> and </s> are text",
             "日本語のテキスト 😀😀", "  leading and   double spaces\n\nand lines\t", "a", "\u0000 null byte", None, "", " ",
             "The harbour was quiet.", "word " * 60_000]
    rows = [(i, t, "w", 1, 1, 5, "e") for i, t in enumerate(texts)] + [(None, "The harbour", None, None, None, None, None), (0, texts[0], "w", 1, 1, 1, "e")]
    return spark.createDataFrame(rows, DOCS).repartition(3)


def brute_scores(rows):
    a_side = token_alignment.ByteBpe(f"{token_alignment.TOKENIZERS}/{token_alignment.FIRST}")
    b_side = token_alignment.PieceBpe(f"{token_alignment.TOKENIZERS}/{token_alignment.SECOND}")
    counts, kept = Counter(), []
    for doc, text in rows:
        a, b = (a_side.encode([text])[0], b_side.encode([text])[0]) if text else ([], [])
        spelt = f" {text}".encode()
        if b"".join(a_side.tokens[i] for i in a) != spelt or b"".join(b_side.tokens[i] for i in b) != spelt:
            a, b = [], []
        groups, links = brute_groups(a, b, a_side.tokens, b_side.tokens)
        counts.update(links)
        kept.append((doc, a, b, groups, links))
    top = {}
    for (_, y), n in counts.items():
        top[y] = max(top.get(y, 0), n)
    out = Counter()
    for doc, a, b, groups, links in kept:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out[(doc, len(a), len(b), len(groups), len(links), sum(counts[k] == top[k[1]] for k in links),
             sum(counts[k] for k in links), hashlib.sha256(text.encode()).hexdigest() if a else "")] += 1
    return out


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_link_scores_against_brute_force(multilingual, monkeypatch):
    rows = [(r.doc_id, r.text) for r in multilingual.collect()]
    want = brute_scores(rows)
    assert Counter(tuple(r) for r in token_alignment.link_scores(multilingual).select(*COLUMNS).collect()) == want
    monkeypatch.setattr(token_alignment, "BLOCK_LINKS", 3)  # many blocks
    monkeypatch.setattr(token_alignment, "PIECE_BYTES", 10)
    assert Counter(tuple(r) for r in token_alignment.link_scores(multilingual).select(*COLUMNS).collect()) == want


def test_aligned_documents_spell_their_texts(multilingual):
    rows = token_alignment.align_documents(multilingual).join(multilingual.select("doc_id", "text").distinct(), "doc_id").collect()
    a_side = token_alignment.ByteBpe(f"{token_alignment.TOKENIZERS}/{token_alignment.FIRST}")
    assert any(r.a_ids for r in rows)
    for r in rows:
        assert sum(r.a_sizes) == len(r.a_ids) and sum(r.b_sizes) == len(r.b_ids)
        if r.a_ids:
            assert b"".join(a_side.tokens[i] for i in r.a_ids) == f" {r.text}".encode()


class Counted:
    """A tokenizer that notes how many characters it was given."""

    def __init__(self, inner):
        self._inner, self.read = inner, 0

    def __getattr__(self, name):
        return getattr(self._inner, name)

    def encode(self, texts):
        self.read += sum(map(len, texts))
        return self._inner.encode(texts)


def tokenizer_pair():
    return (token_alignment.ByteBpe(f"{token_alignment.TOKENIZERS}/{token_alignment.FIRST}"),
            token_alignment.PieceBpe(f"{token_alignment.TOKENIZERS}/{token_alignment.SECOND}"))


def same_alignments(found, want):
    return len(found) == len(want) and all([x.tolist() for x in f] == [x.tolist() for x in w] for f, w in zip(found, want))


def test_repeated_stretches_are_tokenised_once(monkeypatch):
    read = []

    def load(folder, name):
        read.append(Counted(tokenizer_pair()[name == token_alignment.SECOND]))
        return read[-1]

    monkeypatch.setattr(token_alignment, "_load", load)
    texts = ["the harbour was quiet and the sea was calm " * 50, "the sea was quiet " * 200, None, ""]
    batches = [pa.RecordBatch.from_arrays([pa.array(range(4)), pa.array(texts)], ["doc_id", "text"])] * 3
    found = [x for _, part in token_alignment._aligned(iter(batches), "folder", (token_alignment.FIRST, token_alignment.SECOND)) for x in part]
    assert same_alignments(found, token_alignment.align_texts(texts, *tokenizer_pair()) * 3)
    assert all(0 < side.read < 200 for side in read)


@pytest.mark.parametrize("held_bytes", [1, 1 << 20])
def test_stretches_have_the_tokens_of_whole_texts(monkeypatch, held_bytes):
    import random

    monkeypatch.setattr(token_alignment, "HELD_BYTES", held_bytes)  # 1: everything is forgotten again and again
    first, second = tokenizer_pair()
    held, rng = token_alignment._stretches(first, second), random.Random(5)
    spaces = [" ", " ", "  ", "   ", "\t", "\n", "\r\n", "\x0b", "\x1c", "\x85", "\xa0", "\u1680", "\u2003", "\u2028", "\u3000", "\u200b", "\x00"]
    words = ["the", "it's", "we'll", "12", "3.5", "$%", "\u201cq\u201d", "\u00e9", "e\u0301", "\u0301x", "\u043f\u0440\u0438\u0432\u0435\u0442", "\u65e5\u672c",
             "\U0001f600", "<|endoftext|>", "</s>", "<0x0A>", "\ufb01", "\u2581", "a\u2581b"]
    for _ in range(30):
        texts = ["".join(rng.choice(spaces) + rng.choice(words[:rng.choice([17, 19])]) for _ in range(rng.choice([1, 3, 20, 200]))) for _ in range(8)]
        texts += [None, "", " ", "  ", "a ", " a"]
        assert same_alignments(token_alignment.align_texts(texts, first, second, held), token_alignment.align_texts(texts, first, second))


def test_only_known_tokenizers_are_read_by_stretches():
    first, second = tokenizer_pair()
    assert token_alignment._stretches(first, second) is not None
    crossing = Pieces(lambda d: [])
    assert token_alignment._stretches(first, crossing) is None and token_alignment._stretches(crossing, second) is None


def test_alignment_of_nothing(spark):
    assert token_alignment.link_scores(spark.createDataFrame([], DOCS)).count() == 0
    assert token_alignment.align_documents(spark.createDataFrame([], DOCS)).count() == 0
