"""Every operator on small tables: brute force, round trips, held-out accuracy, and the odd cases."""

import base64
import hashlib
import json
import os
import random
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F, types as T

import corpus_pipeline
from vitrine.llm import (common, decontaminate, embedding_dedup, html_text, line_dedup, mixing, paragraph_dedup, quality,
                         secret_scan, simhash, warc)
from vitrine.session import removed, stored

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
random.seed(7)
VOCABULARY = ["".join(random.choice("abcdefghijklmnop") for _ in range(random.randint(2, 9))) for _ in range(3000)]


def prose(n, seed=None):
    rng = random.Random(seed)
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


def documents(spark, rows):
    full = [(i, t, "en", f"s{n % 3}", len(t) if t is not None else None) for n, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, DOCS)


def odd_documents(spark):
    """Nulls in any column, empty, blank and very long texts, ties, repeated rows, names that clash with ours."""
    base = prose(200, 1)
    rows = [(1, base), (1, base), (2, None), (None, base), (None, None), (3, ""), (4, " \n\t \n"), (5, "É ß 漢字 🙂"),
            (6, prose(60_000, 2)), (7, base + " tail"), (8, "x" * 300_000), (9, "a\n" * 5000), (9, "same id, other text")]
    docs = documents(spark, rows)
    clash = {c: F.lit(c) for c in ("row", "fp", "key", "part_id", "no", "words", "n_words", "spans", "text_key", "target", "size", "times",
                                   "draw", "own_id", "id", "node", "root", "first", "gone", "left", "features", "copies")}
    return docs.withColumn("source", F.when(F.col("doc_id") != 6, F.col("source"))).withColumns(clash)


def union_find(items, pairs):
    head = {i: i for i in items}

    def top(x):
        while head[x] != x:
            head[x] = x = head[head[x]]
        return x
    for a, b in pairs:
        head[top(a)] = top(b)
    groups = defaultdict(list)
    for i in items:
        groups[top(i)].append(i)
    return {i: min(g) for g in groups.values() for i in g}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# Connected components.

def test_components_of_chain_star_and_loops(spark):
    chain = [(i, i + 1) for i in range(300)]
    star = [(1000, 1000 + i) for i in range(1, 400)]
    edges = [*chain, *star, (2000, 2000), (2001, 2002), (2002, 2001), (2002, 2001), (None, 5)]
    found = {r.node: r.root for r in common.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = union_find(set(found), [e for e in edges if None not in e and e[0] != e[1]])
    assert len(found) == 301 + 400 + 2
    for group in ({n for n in found if want[n] == w} for w in set(want.values())):
        assert len({found[n] for n in group}) == 1
    assert len(set(found.values())) == 3
    assert common.connected(spark.createDataFrame([], "a long, b long")).count() == 0


# 1. WARC.

def test_warc_round_trip(spark):
    pages = [(3, "http://a/é?q=[1]", "same"), (1, "http://b/", "same"), (1, "http://b/", "same"), (2, None, None), (4, "", ""),
             (None, "http://c/", "line\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"), (5, "http://d/", "é" * 200_000)]
    table = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.round_trip(table).collect()), key=str)
    want = []
    for page, url, page_html in dict.fromkeys(pages):
        body = (page_html or "").encode()
        first = min((p for p, _, h in pages if (h or "") == (page_html or "") and p is not None), default=None)
        want.append((page, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(),
                     "response" if page == first else "revisit", None if page == first else first))
    assert got == sorted(want, key=str)
    least = {r.page_id: r.record_type for r in warc.round_trip(table, least=5).collect()}
    assert least[3] == least[1] == "response"
    assert warc.round_trip(table.limit(0)).count() == 0


def test_warc_captures_nest_what_is_concurrent(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a/x?y=1", "hello")], "page_id long, url string, html string")
    archives = warc.write(pages, str(tmp_path / "w")).collect()
    records = warc.read(spark.createDataFrame(archives))
    row = warc.captures(records).collect()[0]
    assert bytes(row.response.payload) == b"hello" and json.loads(row.metadata[0].payload) == {"page_id": 1, "url": "http://a/x?y=1"}
    assert bytes(row.requests[0].payload) == b"" and row.requests[0].target_uri == "http://a/x?y=1"
    # The response names its request, the metadata names the request only; one request stands alone; ids repeat.
    blank = dict.fromkeys(warc.NAMES)
    own = [blank | {"record_id": "r", "type": "response", "concurrent_to": ["q"]}, blank | {"record_id": "q", "type": "request", "concurrent_to": []},
           blank | {"record_id": "m", "type": "metadata", "concurrent_to": ["q"]}, blank | {"record_id": "m", "type": "metadata", "concurrent_to": ["q"]},
           blank | {"record_id": "alone", "type": "request", "concurrent_to": None}]
    found = {r.capture_id: r for r in warc.captures(spark.createDataFrame([tuple(r[n] for n in warc.NAMES) for r in own], warc.RECORDS)).collect()}
    assert set(found) == {"r", "alone"} and [m.record_id for m in found["r"].metadata] == ["m"]
    assert [q.record_id for q in found["r"].requests] == ["q"] and found["alone"].response is None


def test_warc_damaged_archives(spark, tmp_path):
    good = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <a>\r\nContent-Length: 2\r\n\r\nok\r\n\r\n"
    files = {"cut.warc": good + b"WARC/1.0\r\nWARC-Record-ID: <b>\r\nContent-Length: 99\r\n\r\nshort", "junk.warc": b"nonsense\r\n",
             "bad.warc.gz": b"\x1f\x8bbroken", "fine.warc": good, "empty.warc": b""}
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    listed = spark.createDataFrame([(str(tmp_path / n),) for n in files], "path string")
    found = [(r.archive.rsplit("/", 1)[1], r.record_id, r.problem is None) for r in warc.read(listed).collect()]
    assert sorted(found, key=str) == sorted([("cut.warc", "<a>", True), ("cut.warc", None, False), ("junk.warc", None, False),
                                             ("bad.warc.gz", None, False), ("fine.warc", "<a>", True)], key=str)


# 2. Decontamination.

def test_decontamination_report_and_removal(spark):
    items = [("10", "One two, three four five six seven eight nine TEN eleven"), ("9", "short Item"), ("8", "short item"), ("7", None), ("6", "!!"), (None, "alpha beta")]
    bench = spark.createDataFrame(items, "item_id string, text string")
    rows = [(1, "x one two three four five six seven eight nine ten ELEVEN y"), (2, "a SHORT-item b short item"), (3, "one two three"), (4, None),
            (4, None), (5, "alpha beta"), (None, "shorté item")]
    got = {(r.doc_id, r.n_words, r.n_hit, r.n_items, r.contaminated, r.items_sha256) for r in decontaminate.report(documents(spark, rows), bench).collect()}
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got == {(1, 13, 11, 1, True, digest("10")), (2, 6, 4, 2, True, digest("8,9")), (3, 3, 0, 0, False, digest("")), (4, 0, 0, 0, False, digest("")),
                   (5, 2, 0, 0, False, digest("")), (None, 2, 0, 0, False, digest(""))}
    assert decontaminate.report(documents(spark, rows), bench).count() == len(rows)
    kept = decontaminate.decontaminate(documents(spark, rows), bench)
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([3, 4, 4, 5, None], key=str)
    spans = {r.doc_id: r.text for r in decontaminate.decontaminate(documents(spark, rows), bench, remove="spans").collect()}
    assert spans[1] == "x y" and spans[2] == "a b " and spans[3] == "one two three" and spans[4] is None


def test_decontamination_without_broadcast(spark, docs, monkeypatch):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    with_ = sorted(map(tuple, decontaminate.report(docs, bench).collect()))
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", -1)
    assert sorted(map(tuple, decontaminate.report(docs, bench).collect())) == with_


# 3 and 4. Paragraphs and lines.

def places(rows, normal):
    found = defaultdict(list)
    for i, text in rows:
        for no, part in enumerate((text or "").split("\n")):
            form = normal(part)
            if form:
                found[form].append((i, no))
    return found


def naive_parts(text, passage=51, piece=25):
    """(first word, words) of the parts of a text, one window at a time."""
    words = [w.decode() for w in (text or "").encode().lower().split()]
    shingles = [xxhash.xxh64_intdigest(" ".join(words[i:i + 5]).encode(), 42) for i in range(len(words) - 4)]
    window, found, at = passage - piece + 1, set(), 0
    for i in range(len(shingles) - window + 1):
        least = min(range(i, i + window), key=lambda k: (shingles[k], k))
        if least + piece <= len(words) and shingles[least] not in shingles[max(least - window + 1, 0):least]:
            found.add((least, piece))
    for line in (text or "").split("\n"):
        n = len(line.encode().split())
        if n >= passage:
            found.add((at, n))
        at += n
    return {(no, tuple(words[no:no + n])) for no, n in found}


def test_paragraphs_agree_with_brute_force(spark, docs):
    near = [prose(70, 50)]
    for k in range(60):
        words = near[0].split()
        words[(k * 7) % 70] = f"other{k}"
        near.append(" ".join(words))
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(10_000 + k, f"own {k} words here now\n{p}") for k, p in enumerate(near)]
    members = defaultdict(set)
    for i, text in rows:
        for no, words in naive_parts(text):
            members[words].add((i, no, len(words)))
    forms = sorted(members)
    home = [min(members[f])[0] for f in forms]
    sets = [{f[i:i + 5] for i in range(len(f) - 4)} for f in forms]
    holds = defaultdict(set)
    for i, s in enumerate(sets):
        for x in s:
            holds[x].add(i)
    pairs = [(i, j) for i, s in enumerate(sets) for j in set().union(*(holds[x] for x in s)) if j > i and home[i] != home[j] and len(s & sets[j]) >= .8 * len(s | sets[j])]
    first = union_find(range(len(forms)), pairs)
    group = defaultdict(set)
    for i, f in enumerate(forms):
        group[first[i]] |= members[f]
    want = {(d, no, n, min(m)[0], min(m)[1]) for m in group.values() for d, no, n in m if d != min(m)[0]}
    found = paragraph_dedup.removals(documents(spark, rows), recall=1 - 1e-9, piece_recall=1 - 1e-9).drop("text_key")
    assert len(pairs) > 100 and {tuple(r) for r in found.collect()} == want


def test_passages_inside_paragraphs(spark):
    """Passages of 51 words in different surroundings, over lines, too; what one document repeats, and clean ones, stay."""
    shared = [prose(51, 7000 + k) for k in range(40)]
    rows = [(k, f"{prose(20 + k, k)} {shared[k]} {prose(90 - k, 100 + k)}") for k in range(40)]
    rows += [(100 + k, f"{prose(33, 200 + k)}\n{prose(9 + k, 300 + k)} {shared[k].replace(' ', chr(10), 3 * (k % 2))} {prose(60, 400 + k)}") for k in range(40)]
    clean = [(200 + k, f"{prose(300, 500 + k)} {prose(20, 600)}") for k in range(40)] + [(300, "\n".join([prose(80, 900)] * 3))]
    found = paragraph_dedup.removals(documents(spark, rows + clean)).collect()
    assert {r.doc_id for r in found} == set(range(100, 140)) and all(r.kept_doc_id == r.doc_id - 100 for r in found)
    left = {r.doc_id: r.left for r in paragraph_dedup.dedup(documents(spark, rows + clean)).select("row.doc_id", "left").collect()}
    assert all(left[i] == t for i, t in rows[:40] + clean) and all(len(left[i].split()) <= len(t.split()) - 25 for i, t in rows[40:])


def test_pieces_of_short_texts(spark):
    """Texts of fewer words than a passage have pieces as all others have them."""
    shared = [prose(40, 8000 + k) for k in range(20)]
    rows = [(k, text) for k, text in enumerate(shared)] + [(100 + k, f"{text} {prose(20, 8100 + k)}") for k, text in enumerate(shared)]
    found = paragraph_dedup.removals(documents(spark, rows)).collect()
    assert {(r.doc_id, r.kept_doc_id) for r in found} == {(100 + k, k) for k, text in enumerate(shared) if naive_parts(text)}
    assert len(found) >= 10 and all(r.n_words == 25 for r in found)


def test_paragraphs_meet_wherever_they_are_read_first(spark):
    """Two near paragraphs stand in one document that is read first; an earlier document has one of them as well."""
    rows, want = [], []
    for k in range(0, 400, 10):
        a = prose(80, 8200 + k)
        b = " ".join("other" if n == 3 else w for n, w in enumerate(a.split()))
        rows += [(k + 5, f"{a}\n{b}"), (k + 1, a), (k + 9, b)]
        want += [(k + 5, 0, k + 1), (k + 5, 80, k + 1), (k + 9, 0, k + 1)]
    found = paragraph_dedup.removals(documents(spark, rows).coalesce(1), recall=1 - 1e-9).filter("n_words = 80").collect()
    assert sorted((r.doc_id, r.first_word, r.kept_doc_id) for r in found) == want


def test_cut():
    text = "a b c d\ne f g\nh i"
    assert paragraph_dedup.cut(text, [(1, 2), (2, 1)]) == "a d\ne f g\nh i" and paragraph_dedup.cut(text, [(4, 3)]) == "a b c d\nh i"
    assert paragraph_dedup.cut(text, [(2, 3), (4, 2)]) == "a b g\nh i" and paragraph_dedup.cut(text, []) == text
    assert paragraph_dedup.cut(text, [(0, 9)]) == ""


def test_parts_are_counted_in_the_words_of_the_encoded_text():
    hashes = np.random.default_rng(5).integers(0, 9, 3000).astype(np.uint64)
    least = [min(range(i, i + 7), key=lambda k: (hashes[k], k)) for i in range(len(hashes) - 6)]
    again = {i for i in range(len(hashes)) if hashes[i] in hashes[max(i - 6, 0):i]}
    assert paragraph_dedup.piece_starts(hashes, 7).tolist() == sorted(set(least) - again)
    raw = "a\u00a0b c\x0bd\x1ce\n\u2028f g h\n\n i j\tk l ".encode()
    assert paragraph_dedup.parts_of(raw, hashes[:2], 4, 3, 2) == [(0, 3), (6, 4)]


def test_paragraphs_in_blocks(spark):
    rows = [(k, prose(70, 50).replace(" ", f" w{k} ", 1)) for k in range(90)]
    table = documents(spark, rows)
    small, whole = ({tuple(r) for r in paragraph_dedup.removals(table, block=block).collect()} for block in (8, 256))
    assert small == whole and {r[0] for r in small} == set(range(1, 90)) and all(r[4] < r[0] for r in small)


def test_lines_agree_with_brute_force(spark, docs):
    base = prose(40, 60)
    extra = [(20_000 + k, f"{base} {k}\n{base.replace(VOCABULARY[0], 'q')}{'!' * k}\n\n") for k in range(40)]
    rows = [(r.doc_id, r.text) for r in docs.collect()] + extra
    at = places(rows, line_dedup.normal_form)
    forms = sorted(at)
    prints = np.array(line_dedup._prints(forms)).view(np.uint64)

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            last, row[0] = row[0], i + 1
            for j, y in enumerate(b):
                last, row[j + 1] = row[j + 1], min(row[j + 1] + 1, row[j] + 1, last + (x != y))
        return row[-1]
    pairs = []
    for i in range(len(forms)):
        for j in (np.flatnonzero(np.bitwise_count(prints[i + 1:] ^ prints[i]) <= 3) + i + 1).tolist():
            longer = max(len(forms[i]), len(forms[j]))
            if distance(forms[i], forms[j]) <= .2 * longer + 1e-9:
                pairs.append((i, j))
    first = union_find(range(len(forms)), pairs)
    members = defaultdict(list)
    for i, f in enumerate(forms):
        members[first[i]] += at[f]
    keep = {min(m) for m in members.values()}
    got = {r.row.doc_id: r.left for r in line_dedup.dedup(documents(spark, rows)).collect()}
    for i, text in rows:
        assert got[i] == "\n".join(p for no, p in enumerate(text.split("\n")) if not line_dedup.normal_form(p) or (i, no) in keep)


def test_lines_by_edit_similarity_alone(spark, docs):
    rng, rows, want = random.Random(11), [(r.doc_id, r.text) for r in docs.collect()], defaultdict(list)
    for k in range(400):
        n = (7, 15, 30, 60)[k % 4]
        words = prose(n, 7000 + k).split()
        edited = list(words)
        for at in rng.sample(range(n), 1 if n < 10 else n // 10):
            edited[at] = rng.choice(VOCABULARY)
        if words != edited and line_dedup.similar(" ".join(words), " ".join(edited), 0.8):
            rows += [(50_000 + 2 * k, " ".join(words)), (50_001 + 2 * k, " ".join(edited))]
            want[n].append(50_001 + 2 * k)
    gone = {r.row.doc_id for r in line_dedup.dedup(documents(spark, rows), bits=None).collect() if r.n_removed}
    assert all(sum(i in gone for i in ids) >= 0.93 * len(ids) for ids in want.values()) and min(map(len, want.values())) > 50
    assert not gone & {i - 1 for ids in want.values() for i in ids}
    # All links between the lines of the test table, by brute force and without a bar on bits.
    at = places([(i, t) for i, t in rows if i < 50_000], line_dedup.normal_form)
    forms = sorted(at, key=len)
    pairs = [(i, j) for i, a in enumerate(forms) for j in range(i + 1, len(forms)) if len(a) >= .8 * len(forms[j]) - 1e-9
             and 2 * len({*a.split()} & {*forms[j].split()}) >= len({*a.split()}) and line_dedup.similar(a, forms[j], .8)]
    first = union_find(range(len(forms)), pairs)
    found, kept = line_dedup.groups(docs, bits=None)
    heads = {(r.doc_id, r.no): tuple(r.keeper) for r in found.join(kept, "part_id").collect()}
    together = sum(heads.get(at[forms[i]][0], 0) == heads.get(at[forms[j]][0], 1) for i, j in pairs)
    assert len(pairs) > 20 and together >= 0.95 * len(pairs)
    assert len(set(heads.values())) >= len({first[i] for i, f in enumerate(forms) if at[f][0] in heads})


def test_sections_in_rounds(spark):
    """Rounds give the links that all sections together give; written tables leave no shuffle files, used ones go."""
    base, rng = prose(24, 60).split(), random.Random(6)
    table = documents(spark, [(k, "\n".join(" ".join(rng.choice(VOCABULARY) if rng.random() < .06 else w for w in base[:n]) for n in (7, 24))) for k in range(60)])
    folders = [f.getPath() for f in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    shuffles = lambda: {f for top in folders for _, _, files in os.walk(top) for f in files if f.startswith("shuffle_")}
    before = shuffles()
    own = stored(line_dedup.sets(table), "sets")
    hot = [r.key for r in line_dedup.dealt(own, "keys1").select("key").distinct().collect()]
    kept = shuffles()
    in_rounds = stored(line_dedup.candidates([line_dedup.dealt(own, f"keys{k}", hot) for k in range(line_dedup.ROUNDS)], .8), "found")
    at_once = stored(line_dedup.candidates(line_dedup.sections(table, hot=hot), .8), "found")
    for _ in range(100):
        if not shuffles() - kept:
            break
        time.sleep(.1)
    assert not shuffles() - kept and kept >= before
    distinct = line_dedup.distinct_parts(line_dedup.lines(table, prints=False))

    def together(found):
        links = [(bytes(r.a), bytes(r.b)) for r in line_dedup.edit_links(table, distinct, "doc_id", "text", .8, found=found).collect()]
        return union_find({x for both in links for x in both}, links)
    assert len(together(in_rounds)) > 60 and together(in_rounds) == together(at_once) == together(None)
    folder = os.path.dirname(in_rounds.inputFiles()[0].removeprefix("file://"))
    assert os.path.exists(folder)
    removed(in_rounds)
    assert not os.path.exists(folder) and at_once.count() > 60


def test_each_pair_of_lines_is_looked_at_however_keys_are_dealt(spark):
    """Small keys, large ones, keys beyond `most` and hot keys give the same groups, nearly all that brute force gives."""
    base, rng = prose(24, 60).split(), random.Random(5)
    rows = [(k, "\n".join(" ".join(rng.choice(VOCABULARY) if rng.random() < .06 else w for w in base) for _ in range(3))) for k in range(50)]
    rows += [(100 + k, f"{prose(7, 300 + k // 2)}{k % 2}\n\n{'word ' * 3}{'abcdefghij'[k % 10]}") for k in range(40)]
    table = documents(spark, rows)
    keys = [r.key for r in line_dedup.sections(table).select("key").distinct().collect()]
    results = []
    for hot, direct, most, block in (([], 16, 1024, 512), ([], 2, 1024, 16), ([], 2, 16, 512), (keys, 16, 64, 16), (keys[::2], 3, 32, 512)):
        found = line_dedup.candidates(line_dedup.sections(table, hot=hot), .8, direct, most)
        distinct = line_dedup.distinct_parts(line_dedup.lines(table, prints=False))
        links = line_dedup.edit_links(table, distinct, "doc_id", "text", .8, block, found)
        results.append({(bytes(r.node), bytes(r.root)) for r in common.connected(links).collect()})
    groups = [frozenset(frozenset(n for n, r in found if r == root) for _, root in found) for found in results]
    assert len(set(groups)) == 1 and max(map(len, groups[0])) > 100
    forms = sorted({line_dedup.normal_form(line) for _, text in rows for line in text.split("\n")} - {""})
    pairs = [(i, j) for i in range(len(forms)) for j in range(i + 1, len(forms)) if line_dedup.similar(forms[i], forms[j], .8)]
    first = union_find(range(len(forms)), pairs)
    assert max(map(len, groups[0])) >= .98 * max(Counter(first.values()).values())


def test_edit_distance_against_the_table():
    rng = random.Random(3)
    for _ in range(300):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randint(0, 14))) for _ in range(2))
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            last, row[0] = row[0], i + 1
            for j, y in enumerate(b):
                last, row[j + 1] = row[j + 1], min(row[j + 1] + 1, row[j] + 1, last + (x != y))
        assert line_dedup.edit_distance(a, b) == row[-1], (a, b)
        for most in (0, 1, 2.6, 5):
            got = line_dedup.edit_distance(a, b, most)
            assert got == row[-1] if row[-1] <= most else most < got <= row[-1], (a, b, most)


def test_most_pairs_of_lines_are_decided_without_their_distance(monkeypatch):
    """Bounds of the edit distance hold, and spare most pairs the measuring; what is linked stays what brute force links."""
    rng, forms = random.Random(17), []
    for k in range(120):
        words = prose(rng.choice((3, 12, 40)), 800 + k).split()
        forms += [" ".join(w if rng.random() > share else rng.choice([w[1:], "é漢", w + " w", rng.choice(VOCABULARY)]) for w in words) for share in (0, .05, .15, .3)]
    a, b = np.array([(i, j) for i in range(len(forms)) for j in range(i + 1, min(i + 9, len(forms)))]).T
    near = [line_dedup.similar(forms[i], forms[j], .8) for i, j in zip(a, b)]
    assert not (line_dedup._apart(forms, a, b, .8) & near).any()
    assert all(line_dedup.word_bound(forms[i], forms[j], 1e9) >= line_dedup.edit_distance(forms[i], forms[j]) for i, j in zip(a, b))
    measured = []
    monkeypatch.setattr(line_dedup, "similar", lambda x, y, least, own=line_dedup.similar: measured.append(x) or own(x, y, least))
    links = line_dedup._forest(forms, a, b, .8)
    want = union_find(range(len(forms)), [(i, j) for i, j, ok in zip(a.tolist(), b.tolist(), near) if ok])
    assert union_find(range(len(forms)), links) == want and len(links) == len(forms) - len(set(want.values())) and len(measured) < len(a) / 4


def test_pairs_of_lines_are_measured_together(monkeypatch):
    """Pairs that no bound decides are measured side by side, with the answers of one distance at a time."""
    rng, a, b = random.Random(23), [], []
    for k in range(900):
        text = "".join(rng.choice("abcde é漢𝒜") for _ in range(rng.choice((0, 1, 63, 64, 65, 130, 300, 700))))
        a.append(text)
        b.append("".join(ch if rng.random() > .25 * (k % 3) else rng.choice(("", "x", ch + "y")) for ch in text))
    most = np.array([.2 * max(len(x), len(y)) + 1e-9 for x, y in zip(a, b)])
    want = [line_dedup.edit_distance(x, y) <= m for x, y, m in zip(a, b, most)]
    for cells in (1 << 22, 1 << 13):
        monkeypatch.setattr(line_dedup, "CELLS", cells)
        assert line_dedup._near(a, b, most).tolist() == want and 100 < sum(want) < 800
    alone = []
    monkeypatch.setattr(line_dedup, "edit_distance", lambda x, y, most=None, own=line_dedup.edit_distance: alone.append(x) or own(x, y, most))
    forms = [x for x in a + b if len(x) > 50]
    first = np.arange(len(forms) // 2)
    links = line_dedup._forest(forms, first, first + len(first), .8)
    assert links and len(alone) < len(first) / 20


# 5. Embeddings.

def test_embeddings_agree_with_brute_force(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(30, 16))
    tight = centres[:4].repeat([150, 40, 3, 2], axis=0) + rng.normal(size=(195, 16)) * 0.12
    x = np.concatenate([rng.normal(size=(800, 16)), tight, tight[:5] * 3.0, tight[:2]]).astype(np.float32)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    odd = [(5000, None, 0), (5001, [0.0] * 16, 0), (5002, [float("nan")] * 16, 0), (5003, [float("inf")] + [1.0] * 15, 0), (5004, [], 0),
           (5005, [1.0, 2.0], 0), (None, x[0].tolist(), 0), (5006, [None] + [1.0] * 15, 0)]
    schema = "vec_id long, embedding array<float>, label int"
    table = spark.createDataFrame(rows + odd, schema).withColumns({"node": F.lit(1), "v": F.lit(2), "links": F.lit(3)})
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.groups(table).collect()}
    unit = embedding_dedup.unit(x.tolist())
    linked = unit @ unit.T >= 0.95
    np.fill_diagonal(linked, False)
    first = union_find(range(len(x)), np.argwhere(linked).tolist())
    found = sum(got[i][0] for i in range(len(x)))
    assert all(got[i][0] <= linked[i].sum() for i in range(len(x))) and found >= 0.99 * linked.sum()
    assert sum(got[i][1] != first[i] for i in range(len(x))) <= 2
    assert all(got[i] == (0, i, True) for i in range(5000, 5007)) and got[None] == (0, None, None)
    assert embedding_dedup.audit(table.select("vec_id", "embedding").filter("vec_id < 5000"), embedding_dedup.groups(table)) >= 0.9
    assert embedding_dedup.groups(table.limit(0)).count() == 0


def test_embedding_shards_split_and_meet_in_blocks(spark):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(size=(600, 12)), rng.normal(size=12) + rng.normal(size=(250, 12)) * 0.05])
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found, linked = embedding_dedup.links(table, block=100)
    counts = {r.node: r.n for r in linked.groupBy("node").agg(F.sum("n_links").alias("n")).collect()}
    unit = embedding_dedup.unit(x.tolist())
    true = (unit @ unit.T >= 0.95).sum(axis=1) - 1
    assert all(counts.get(i, 0) <= true[i] for i in range(len(x))) and sum(counts.values()) >= 0.95 * true.sum()


# 6. Quality.

def test_the_training_sample_is_bounded_by_rows(spark):
    """One labelled id on many rows: repeats count once, different texts not above the bound."""
    rows = [(1, "same text")] * 50 + [(2, f"other {k}") for k in range(50)] + [(3, "alone"), (4, None), (None, "nobody")]
    labels = spark.createDataFrame([(1, 0), (2, 2), (3, 1), (4, 1), (9, 1), (None, 2)], "doc_id long, grade int")
    found, share = quality.sample(documents(spark, rows), labels, per_grade=7)
    assert Counter(r.grade for r in found.collect()) == {0: 1, 1: 2, 2: 7} and share.tolist() == [1, 3, 1]


def test_quality_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", quality.grade().alias("grade"))
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    model = quality.train(docs, labels.filter(half))
    held = quality.rate(docs.join(labels.filter(~half), "doc_id"), model)
    rows = held.select("row.grade", "accepted", "expected_grade", "tail_probability").collect()
    right = sum(r.accepted == (r.grade == 2) for r in rows) / len(rows)
    clean = [r for r in rows if r.grade == 2]
    mean = {g: np.mean([r.expected_grade for r in rows if r.grade == g]) for g in (0, 1, 2)}
    assert right > 0.93 and sum(r.accepted for r in clean) / len(clean) > 0.95 and mean[0] < mean[1] < mean[2]
    assert model.thresholds[0] < model.thresholds[1] and all(0 <= r.tail_probability <= 1 for r in rows)


# 7. HTML.

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body class="has-sidebar">
<div class="cookie-notice">We use cookies on this site and you can read all about it in the policy of the site.</div>
<header class="site-header"><a href="/">Home</a> The best of the web</header><nav><ul><li><a href="/a">A</a></li></ul></nav>
<div id="content"><h1>Heading &amp; more</h1><p>It was the best of times, it was the worst of times, it was the age of wisdom, it was
the age of foolishness, and all of it was in the book that I had by the bed when it was out &copy so that I could read it.<p>Short one.</p>
<p>There is a second paragraph that is long enough to be judged by itself, as it has many of the words that the rules look for, and so
it will be taken for the main text of the page by the first pass, as it should be.</div>
<div class="sidebar"><p>There is more in the sidebar that is of no use to you, but it has the words of a text.</p></div>
<form><label>Name</label><input name=a></form><section id="comments"><p>I do not like it at all, and it is all wrong, as I have said to you.</p></section>
<footer>&copy; 2020 by the owner of the site</footer></body></html>"""


def test_html_rules():
    got = html_text.main_text(PAGE).split("\n")
    assert got[0] == "Heading & more" and got[1].startswith("It was the best") and "©" in got[1] and got[2] == "Short one."
    assert got[3].startswith("There is a second") and len(got) == 4
    article = "<nav><a href=x>Menu</a></nav><article><header><h1>Title</h1></header>Zzz  qq<br>ww &lt;b&gt;<p>x<div class='share-buttons'>Tweet</div><p>y</article>"
    assert html_text.main_text(article) == "Title\nZzz qq ww <b>\nx\ny"
    for broken in ("", "<", "<p", "<a href='", "<!--", "</div></p>", "<script>x", "&#xZZ;", "<p>" * 3000, "<div class=\"" * 2000):
        assert isinstance(html_text.main_text(broken), str)


def test_html_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    for r in html_text.extract(pages).collect():
        assert r.n_chars == len(r.text) > 0 and "\n\n" not in r.text
    odd = spark.createDataFrame([(1, None, None), (None, "u", ""), (2, "u", PAGE), (2, "u", PAGE)], "page_id long, url string, html string")
    got = html_text.extract(odd.withColumn("text", F.lit("clash"))).collect()
    assert len(got) == 4 and sorted(r.n_chars for r in got)[:2] == [0, 0] and html_text.extract(odd.limit(0)).count() == 0


# 8. Mixing.

def test_mixing_shares_and_draws(spark):
    rows = [(i, prose(50, i), "en", "abcd"[i % 4] if i % 5 else None, 0) for i in range(2000)] + [(9000, None, "en", "z", 0), (None, "one two", "en", "a", 0)]
    table = spark.createDataFrame(rows, DOCS)
    plan = mixing.plan(table).collect()
    assert len(plan) == len(rows) and mixing.plan(table).collect() and {r.times for r in plan} <= {0, 1, 2, 3}
    total = sum(r.size for r in plan)
    target = {r.source: r.target for r in plan}
    size = {r.source: r.source_size for r in plan}
    assert sum(target.values()) == pytest.approx(total) and all(target[s] <= 3 * size[s] + 1e-6 for s in target)
    taken = defaultdict(int)
    for r in plan:
        taken[r.source] += r.size * r.times
    assert all(abs(taken[s] - target[s]) <= 0.2 * target[s] + 100 for s in target)
    mixed = mixing.mix(table)
    assert mixed.columns == table.columns and mixed.count() == sum(r.times for r in plan)
    assert sorted(map(str, mixed.collect())) == sorted(map(str, mixing.mix(table).collect()))


@pytest.mark.parametrize("sizes", [[1, 1, 1000], [1000, 1, 1], [5, 0, 7, 9, 100], [3], [0, 0], [10, 10, 10, 10, 10, 10, 10]])
def test_mixing_targets_fill_up(spark, sizes):
    table = spark.createDataFrame([(f"s{i}", n) for i, n in enumerate(sizes)], "source string, source_size long")
    got = [r.target for r in mixing.targets(table).orderBy("source").collect()]
    weights, open_, target = [1 + i % 3 for i in range(len(sizes))], set(range(len(sizes))), [0.0] * len(sizes)
    while open_:
        rest, w = sum(sizes) - sum(target[i] for i in range(len(sizes)) if i not in open_), sum(weights[i] for i in open_)
        full = {i for i in open_ if rest * weights[i] / w > 3 * sizes[i]}
        for i in full or open_:
            target[i] = 3 * sizes[i] if full else rest * weights[i] / w
        open_ -= full or open_
    assert got == pytest.approx(target)


# 9. SimHash.

def test_simhash_agrees_with_brute_force(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(30_000 + k, f"{prose(400, 70)} {k % 20} {k}") for k in range(300)]
    rows += [(40_000, None), (40_001, ""), (40_002, "one"), (40_003, " ONE\t"), (40_004, "É é")]

    def print_of(text):
        words = (text or "").encode().lower().split()
        hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 3]), 42) for i in range(max(1, len(words) - 2))] if words else []
        return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))
    prints = {i: print_of(t) for i, t in rows}
    ids = sorted(prints)
    values = np.array([prints[i] for i in ids], np.uint64)
    pairs = [(ids[a], ids[b]) for a in range(len(ids)) for b in np.flatnonzero(np.bitwise_count(values[a] ^ values) <= 2).tolist()]
    first = union_find(ids, pairs)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.groups(documents(spark, rows)).collect()}
    assert got == {i: (f"{prints[i]:016x}", first[i]) for i in ids}


def test_hamming_links_of_dense_fingerprints(spark):
    rng = np.random.default_rng(8)
    base = rng.integers(0, 1 << 62, 3)
    values = sorted({int(b) ^ int(m) for b in base for m in rng.integers(0, 1 << 11, 900)} | set(rng.integers(-(1 << 62), 1 << 62, 500).tolist()))
    unsigned = np.array(values).view(np.uint64)
    for bits in (2, 3):
        pairs = [(values[a], values[b]) for a in range(len(values)) for b in np.flatnonzero(np.bitwise_count(unsigned[a] ^ unsigned) <= bits).tolist()]
        want = union_find(values, pairs)
        edges = simhash.hamming_links(spark.createDataFrame([(v,) for v in values], "fp long"), bits, block=100)
        assert union_find(values, [(r.a, r.b) for r in edges.collect()]) == want


def test_near_copies_by_similarity(spark):
    rows, truth = [], {}
    for k in range(120):
        words = prose(300, 100 + k).split()
        rows.append((2 * k, " ".join(words)))
        changed = list(words)
        for at in range(3, 300, 60 if k % 2 else 12):  # about 0.86 or 0.4 of the shingles stay in common
            changed[at] = "edited"
        rows.append((2 * k + 1, " ".join(changed)))
        truth[2 * k + 1] = 2 * k if k % 2 else 2 * k + 1
    got = {r.doc_id: r.component_id for r in simhash.near_copies(documents(spark, rows)).collect()}
    assert sum(got[i] == t for i, t in truth.items() if i != t) >= 57 and all(got[i] == i for i, t in truth.items() if i == t)
    assert all(got[i] == i for i in got if i % 2 == 0)
    kept = {r.doc_id for r in simhash.keep_one(documents(spark, rows)).collect()}
    assert kept == {i for i, c in got.items() if i == c}


def shingle_jaccard(a, b):
    a, b = ({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} for w in (a.split(), b.split()))
    return len(a & b) / len(a | b)


def edited_pairs(n_words, n, rng, seed, low, high):
    """Pairs of texts with a similarity from `low` to below `high`, cut at an end or with single words edited."""
    found, k = [], 0
    while len(found) < n:
        k += 1
        words = prose(n_words, seed + k).split()
        other = list(words)
        for at in rng.sample(range(n_words), rng.randint(0, max(1, n_words // 25))):
            other[at] = f"edit{at}"
        other = other[:n_words - rng.randint(0, max(1, n_words // 4))]
        if low <= shingle_jaccard(" ".join(words), " ".join(other)) < high:
            found.append((" ".join(words), " ".join(other)))
    return found


def test_near_copies_on_both_sides_of_the_threshold(spark):
    rng = random.Random(21)
    for_far = edited_pairs(300, 150, rng, 21_000, 0.74, 0.795)
    for_near = edited_pairs(300, 150, rng, 31_000, 0.805, 0.83)
    rows = [(2 * k + side, pair[side]) for k, pair in enumerate(for_far + for_near) for side in (0, 1)]
    got = {r.doc_id: r.component_id for r in simhash.near_copies(documents(spark, rows)).collect()}
    linked = [got[2 * k + 1] == 2 * k for k in range(300)]
    assert not any(linked[:150]) and sum(linked[150:]) >= 0.93 * 150


def test_near_copies_of_texts_of_any_length(spark):
    rng, rows, lengths = random.Random(22), [], (6, 9, 14, 20, 30, 50, 80, 103, 115, 130, 200)
    for n in lengths:
        for pair in edited_pairs(n, 60, rng, 100_000 * n, 0.5 if n < 9 else 0.8, 1.0):
            rows += [(len(rows), pair[0]), (len(rows) + 1, pair[1])]
    got = {r.doc_id: r.component_id for r in simhash.near_copies(documents(spark, rows)).collect()}
    for at, n in enumerate(lengths):
        want = [shingle_jaccard(rows[i][1], rows[i + 1][1]) >= 0.8 for i in range(120 * at, 120 * at + 120, 2)]
        linked = [got[i + 1] == i for i in range(120 * at, 120 * at + 120, 2)]
        assert linked == want if n < 120 else sum(linked) >= 0.95 * sum(want), n


# 10. Secrets.

def test_secret_scan_on_held_out_findings(spark):
    rng = random.Random(9)
    hexes = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    rows = []
    for k in range(300):
        secret, public = f'token = "{hexes(40)}"', f"order {rng.randint(10**16, 10**17)} or http://site{k}.example.com/page{k}"
        rows.append((k, f"{prose(20, k)} {secret if k % 2 else public} {prose(5, k)} card {rng.randint(10**15, 10**16)}"))
    rows += [(1000, None), (1001, ""), (1002, "password=" + "a1B2" * 6), (None, "AKIA" + "ABCD1234EFGH5678")]
    got = secret_scan.scan(documents(spark, rows)).collect()
    secrets = {r.doc_id for r in got if r.is_secret}
    assert secrets == {k for k in range(300) if k % 2} | {1002, None}
    assert not any(r.is_secret for r in got if r.candidate.isdigit()) and all(0 <= r.probability <= 1 for r in got)
    table = documents(spark, rows)
    text = {r.doc_id: r.text for r in secret_scan.redact(table, secret_scan.scan(table)).collect()}
    assert "[secret]" in text[1] and "token" in text[1] and text[1000] is None and "[secret]" not in text[0]


def test_secret_scan_takes_labelled_findings(spark):
    found = [(f"KEY-{n}-{'x7Q' * 6}", "my key: ", "", 1) for n in range(30)] + [(f"build-{n}-artifact-name-9", "see file ", "", 0) for n in range(30)]
    labelled = spark.createDataFrame(found, "candidate string, before string, after string, label int")
    got = secret_scan.scan(documents(spark, [(1, "my key: KEY-77-x7Qx7Qx7Qx7Qx7Qx7Q and see file build-99-artifact-name-9")]), labelled).collect()
    assert {r.candidate[:3]: r.is_secret for r in got} == {"KEY": True, "bui": False}


# Odd cases of all that take documents, and the pipeline.

def test_odd_documents(spark):
    table = odd_documents(spark)
    bench = spark.createDataFrame([("1", prose(200, 1))], "item_id string, text string")
    labels = spark.createDataFrame([(1, 2), (3, 0), (None, 1), (5, None), (7, 1)], "doc_id long, grade int")
    n = table.count()
    assert decontaminate.report(table, bench).count() == n and simhash.groups(table).count() == n and mixing.plan(table).count() == n
    assert quality.rate(table, quality.train(table, labels)).count() == n and line_dedup.dedup(table).count() == n
    assert paragraph_dedup.removals(table).count() > 0 and paragraph_dedup.dedup(table).count() == n
    assert secret_scan.scan(table).count() >= 0
    for out in (quality.select(table, labels), simhash.keep_one(table), decontaminate.decontaminate(table, bench), mixing.mix(table),
                decontaminate.decontaminate(table, bench, remove="spans")):
        assert out.columns == table.columns and out.count() <= 3 * n
    one = [r.doc_id for r in simhash.keep_one(table).collect()]
    assert one.count(1) == 1 and 7 not in one and 6 in one and one.count(9) == 2


def test_empty_tables(spark):
    table = documents(spark, [])
    bench = spark.createDataFrame([], "item_id string, text string")
    labels = spark.createDataFrame([], "doc_id long, grade int")
    for out in (decontaminate.report(table, bench), simhash.groups(table), simhash.keep_one(table), mixing.plan(table), mixing.mix(table),
                line_dedup.dedup(table), paragraph_dedup.removals(table), quality.select(table, labels), secret_scan.scan(table),
                decontaminate.decontaminate(table, bench)):
        assert out.count() == 0
    some = documents(spark, [(1, "some words here")])
    assert decontaminate.decontaminate(some, bench).count() == 1 and quality.rate(some, quality.train(some, labels)).count() == 1


def test_pipeline_stages(spark, tmp_path):
    rows = [(k, f"The {prose(150, k)}\nlast line {prose(12, 10_000 + k)}") for k in range(150)]
    bad = [(200 + k, " ".join(f"{w.upper()}!!" for w in prose(8, 900 + k).split()) * 20) for k in range(50)]
    near = [(300, rows[5][1].replace("\n", " ").replace("The", "A")), (301, rows[6][1] + "\nThis line is on two documents"), (302, "This line is on two documents")]
    leak = [(400, f"{prose(100, 5077)} {prose(30, 5078)} {prose(100, 5079)}")]
    docs = documents(spark, rows + bad + near + leak)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    grades = [(i, 1, 0) for i, _ in rows[:100]] + [(i, 0, 0) for i, _ in bad[:30]]
    spark.createDataFrame(grades, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, prose(30, 5078))], "item_id int, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    kept = docs
    ids = []
    for name, stage in corpus_pipeline.STAGES:
        kept = stage(spark, kept, str(tmp_path))
        assert kept.columns == docs.columns, name
        ids.append({r.doc_id for r in kept.select("doc_id").collect()})
    assert not ids[0] & {i for i, _ in bad} and ids[0] >= {i for i, _ in rows}
    assert 302 not in ids[1] or 301 in ids[1]
    assert 300 not in ids[2] and ids[2] >= {i for i, _ in rows} and 400 in ids[2] and 400 not in ids[3] and ids[3] >= {i for i, _ in rows}
    assert ids[4] <= ids[3] and corpus_pipeline.run(spark, str(tmp_path)).count() > 0
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "quality_classifier" and isinstance(kept.schema["doc_id"].dataType, T.LongType)


def test_mixing_draws_different_texts_of_one_id_apart(spark):
    """One id on a third of the rows: its source meets its target as any other."""
    rows = [(7 if n % 3 == 0 else n, f"{prose(5, n)}") for n in range(6000)]
    table = documents(spark, rows).withColumn("source", F.when(F.col("doc_id") == 7, "b").otherwise("a"))
    taken = mixing.plan(table).groupBy("source").agg(F.sum(F.col("size") * F.col("times")).alias("taken"), F.first("target").alias("target")).collect()
    assert all(abs(r.taken - r.target) < 0.06 * r.target for r in taken) and len(taken) == 2
