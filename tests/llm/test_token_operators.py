"""Tokenizer alignment, spelling variants and document fingerprints against brute force, and on odd tables."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from test_llm_operators import documents, odd_documents, prose
from vitrine.llm import fingerprints, spelling, token_alignment
from vitrine.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
ODD_TEXTS = ["", None, " ", "  ", "word", " word", "word  ", "a\n\nb", "\nNext line\n", "tab\t x\r\n y", "é漢字🙂 x🙂🙂", "▁ low line", "<s> </s> <unk> <|endoftext|> x",
             "<0x41> literal", "x" * 3000, "漢" * 400, "it's we'll  don't", " nb sp  em", "a​b ́c", "\x00nul \x1f us", "ﬁ ligature Å Å", "1234 56.78", "same", "same"]


def brute_alignment(texts):
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(token_alignment.BYTE_BPE)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=token_alignment.PIECE_BPE)
    plain = [x for x in range(256) if 33 <= x <= 126 or 161 <= x <= 172 or 174 <= x <= 255]
    back = {chr(x): x for x in plain} | {chr(256 + n): x for n, x in enumerate(x for x in range(256) if x not in plain)}
    links, out = [], []
    for text in texts:
        own, groups = [], []
        if text:
            ia, ib = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            ba = [bytes(back[c] for c in a.id_to_token(i)) for i in ia]
            bb = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ib]
            if b"".join(ba) == b"".join(bb) == (" " + text).encode():
                spans = [[(e - len(x), e) for x, e in zip(side, np.cumsum([len(x) for x in side]).tolist())] for side in (ba, bb)]
                ends = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
                for lo, hi in zip([0, *ends], ends):
                    groups.append("|".join(",".join(str(i) for i, (s, e) in zip(ids, side) if lo <= s and e <= hi) for ids, side in zip((ia, ib), spans)))
                first = 0  # tokens before it end before the token at hand
                for i, (s, e) in zip(ia, spans[0]):
                    while spans[1][first][1] <= s:
                        first += 1
                    for j, (s2, e2) in zip(ib[first:], spans[1][first:]):
                        if s2 >= e:
                            break
                        own.append((i, j))
        links.append(own)
        out.append((len(ia), len(ib), len(groups), groups) if groups else (0, 0, 0, []))
    counts = Counter(x for own in links for x in own)
    most = {}
    for (_, j), n in counts.items():
        most[j] = max(most.get(j, 0), n)
    return [(n_a, n_b, n_g, len(own), sum(counts[x] == most[x[1]] for x in own), sum(counts[x] for x in own), ";".join(groups))
            for (n_a, n_b, n_g, groups), own in zip(out, links)]


@pytest.mark.parametrize("frequent", [token_alignment.FREQUENT, 40])
def test_alignment_agrees_with_whole_texts(spark, frequent):
    texts = ODD_TEXTS + [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").limit(60).collect()]
    found = token_alignment.align(documents(spark, list(enumerate(texts))).repartition(3), frequent=frequent)
    got = {r.doc_id: tuple(r[c] for c in (*token_alignment.NUMBERS, "groups")) for r in found.collect()}
    assert [got[i] for i in range(len(texts))] == brute_alignment(texts)
    digests = token_alignment.digests(documents(spark, list(enumerate(texts))), frequent=frequent).collect()
    assert {r.doc_id: r.groups_sha256 for r in digests} == {i: hashlib.sha256(got[i][-1].encode()).hexdigest() if got[i][-1] else "" for i in got}


def test_alignment_forgets_stretches(spark, monkeypatch):
    texts = [prose(80, n) for n in range(30)]
    own = token_alignment.Aligner(token_alignment.BYTE_BPE, token_alignment.PIECE_BPE)
    monkeypatch.setattr(token_alignment, "KNOWN", 50)
    for text, (n_a, n_b, n_groups, n_links, *_) in zip(texts, brute_alignment(texts)):
        (ids,) = own.ids([own.stretches(text)])
        assert own.sizes[ids].sum(axis=0).tolist() == [n_a, n_b, n_groups, n_links]
    assert own.cleared > 2


def test_alignment_needs_the_ids_alone():
    """Ends of tokens follow from the lengths of their bytes: no offsets are asked of sentencepiece."""
    own = token_alignment.Aligner(token_alignment.BYTE_BPE, token_alignment.PIECE_BPE)
    ids, texts = own.b.encode, ["é漢🙂 a\n\n b", "two  words, ½ ▁ <0x0A>", "\n", " "]
    own.b = type("Ids", (), {"encode": staticmethod(lambda given, out_type: ids(given, out_type=out_type))})
    for text, want in zip(texts, brute_alignment(texts)):
        (_, (found,)), = own.batches(pa.array([text]))
        assert tuple(own.sizes[found].sum(axis=0).tolist()) == tuple(want[:4])
        assert "".join(own.groups[k] for k in found.tolist())[:-1] == want[-1]


def test_alignment_of_odd_tables(spark):
    docs = odd_documents(spark)
    found = token_alignment.digests(docs).collect()
    assert len(found) == docs.count()
    assert all(r.n_links == 0 and r.groups_sha256 == "" for r in found if r.doc_id == 2)
    assert len({tuple(r) for r in found if r.doc_id == 1}) == 1
    empty = token_alignment.digests(docs.limit(0))
    assert empty.count() == 0 and empty.columns[-1] == "groups_sha256"


def brute_variants(rows, ratio=5, drop=199, length=6, least=5):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{run}".encode())
            if h % drop == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= length and n >= least}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))
    out, forms = {}, {}
    for w, n in words.items():
        close = [x for x in words if x != w and near(w, x)]
        best = min(close, key=lambda x: (-words[x], x), default=None)
        forms[w] = best if best is not None and words[best] >= ratio * n else None
        out[w] = (n, len(close), words[forms[w]] if forms[w] else None)

    def root(w):
        while forms[w] is not None:
            w = forms[w]
        return w
    return sorted((w, forms[w], root(w), *out[w]) for w in words)


def noisy_documents(seed, n=240):
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(6, 10))) for _ in range(50)]

    def spoiled(w):
        for _ in range(rng.choice((0, 0, 0, 0, 1, 1, 2))):
            i, how = rng.randrange(len(w) + 1), rng.randrange(3)
            w = w[:i] + rng.choice("abz") + w[i:] if how == 0 else w[:i] + w[i + 1:] if how == 1 else w[:i] + rng.choice("abÿ") + w[i + 1:]
        return w
    return [(i, " ".join(spoiled(rng.choice(stems[:rng.choice((3, 10, 50))])).capitalize() for _ in range(120))) for i in range(n)]


@pytest.mark.parametrize("block", [2048, 16])
def test_variants_agree_with_all_pairs(spark, block):
    rows = noisy_documents(block) + [(None, "Ünderway x×y÷z " * 5), (7, None), (8, "")]
    found = spelling.variants(documents(spark, rows), block=block, drop_one_in=7)
    got = sorted((tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in found.collect()))
    assert got == brute_variants(rows, drop=7)
    assert any(r[2] not in (r[0], r[1]) for r in got) and sum(r[4] for r in got) > 200  # chains of forms


def test_near_words_at_the_ends_of_words():
    base = "abcdef"
    longer = {base[:i] + c + base[i:] for i in range(7) for c in "abz"}
    other = {base[:i] + c + base[i + 1:] for i in range(6) for c in "abz"} - {base}
    words = [base, *sorted(longer), *sorted(other), "abcdexy", "bacdef", "abcde"]
    a, b = spelling.near_words([base], words)
    assert {words[i] for i in b} == longer | other and len(b) == len(longer | other) and not a.any()


def test_variants_of_odd_tables_and_long_words(spark):
    docs = odd_documents(spark)
    assert spelling.variants(docs.limit(0)).count() == 0
    assert {r.word for r in spelling.variants(docs).collect()} == {w for w, *_ in brute_variants([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])}
    rows = [(i, " ".join(["y" * 500, "y" * 250 + "z" + "y" * 250, "y" * 499 + "w"])) for i in range(5)]
    found = spelling.variants(documents(spark, rows), drop_one_in=1 << 40).collect()
    assert sorted(r.n_near for r in found) == [1, 1, 2]


def jaccard(a, b):
    def grams(t):
        w = t.encode().lower().split()
        return {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()
    x, y = grams(a), grams(b)
    return 1.0 if x == y else len(x & y) / len(x | y)


def test_likeness_follows_shingles():
    known, errors = fingerprints._Known(), []
    for n in range(150):
        words = prose(random.Random(n).choice((30, 80, 200, 900, 5000)), n).split()
        at = random.Random(n).randrange(len(words))
        a, b = " ".join(words), " ".join(words[:at] + prose(len(words) - at, n + 1000).split())
        x, y = fingerprints.fingerprint(a, known), fingerprints.fingerprint(b, known)
        errors.append(fingerprints.likeness(x, y) - jaccard(a, b))
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.05 and max(map(abs, errors)) < 0.2
    same = fingerprints.fingerprint("One two", known)
    assert fingerprints.likeness(same, fingerprints.fingerprint("one\n TWO ", known)) == 1.0
    assert not fingerprints.fingerprint(" \n").any() and not fingerprints.fingerprint(None).any()


def test_densified_bins_take_values_of_their_orders():
    hashes = fingerprints.shingles(fingerprints.word_hashes(prose(40, 3), fingerprints._Known()))
    bins = {}
    for h in hashes.tolist():
        bins[h >> 55] = min(h, bins.get(h >> 55, h))
    for i, value in enumerate(fingerprints.values(hashes).tolist()):
        own = i if i in bins else next(j for j in fingerprints.PROBES[i].tolist() if j in bins)
        assert value == bins[own] & 15


@pytest.mark.parametrize("parts", [1, 7])
def test_edited_texts_agree_with_a_loop(spark, parts):
    rows = [(i * 3, prose(random.Random(i).randrange(1, 200), i)) for i in range(60)] + [(1000, ""), (1001, None), (1002, "🙂é" * 7), (1003, prose(5000, 5))]
    found = {r.doc_id: r for r in fingerprints.edited(documents(spark, rows).repartition(parts, "doc_id")).collect()}
    assert len(found) == len(rows)
    ordered = [(i, t or "") for i, t in sorted(rows)]
    for (i, text), (_, other) in zip(ordered, ordered[1:] + ordered[:1]):
        half, r = len(text) // 2, found[i]
        edited = text[:len(text) - half] + other[:half]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        own = [fingerprints.fingerprint(t) for t in (text, edited, other)]
        assert r.fingerprint == fingerprints.packed(own[0]).hex() and r.edited_fingerprint == fingerprints.packed(own[1]).hex()
        assert (r.near_edited, r.near_next) == (fingerprints.likeness(own[0], own[1]), fingerprints.likeness(own[0], own[2]))
        assert len(r.fingerprint) == 512


def test_edited_texts_of_odd_tables(spark):
    docs = odd_documents(spark)
    found = fingerprints.edited(docs).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(r.doc_id) for r in docs.select("doc_id").collect())
    assert len({r.fingerprint for r in found if r.doc_id == 1}) == 1
    assert fingerprints.edited(docs.limit(0)).count() == 0
    (one,) = fingerprints.edited(documents(spark, [(5, "alone on the page here")])).collect()
    assert one.near_next == 1.0
    same = fingerprints.edited(documents(spark, [(1, prose(50, 1))] * 40).repartition(8)).collect()
    assert len(same) == 40 and {r.near_next for r in same} == {1.0}


def test_fingerprints_of_rows(spark):
    docs = odd_documents(spark)
    found = fingerprints.fingerprints(docs).collect()
    assert len(found) == docs.count() and all(r.fingerprint == "0" * 512 for r in found if r.doc_id in (2, 3, 4))
