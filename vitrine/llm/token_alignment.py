"""Cross-tokenizer alignment: which tokens of a byte-level BPE and of a sentencepiece BPE cover the same bytes.

Both tokenizers work within stretches of text: neither joins a character that is no white space to a space or line break
that follows it, nor a letter to a mark that follows it (checked against the vocabularies when they are loaded; where that
does not hold, the whole text is one stretch). A stretch is tokenized once per task for all its occurrences.

1. Token ends in bytes: the lengths of the tokens' decoded bytes, added up. The bytes of all tokens must be the text, so that
   parts of multibyte characters and byte fallback need no care.
2. Offsets where tokens of both sides end cut a stretch into groups; two tokens whose byte ranges overlap are linked. The
   links of each document are written once, as one number a link.
3. Links of each pair of ids are counted over the corpus, summed per batch before the shuffle.
4. Each pair gets its count and whether no pair with the same B id has more. The `frequent` pairs, those with at least
   1 / frequent of all links and so at most that many, are sent to the tasks that read the links again; links of rarer pairs
   are joined by a shuffle of (row, pair, links), which has no hot key as each of them is rare.

Defined results: null, empty and unfaithfully tokenized texts have no tokens: zeros and an empty digest, and their links do
not count. Repeated rows and repeated ids are rows of their own and all count. Null ids stay. An empty table gives an empty
result. Other columns are ignored, whatever their names. The tokenizer files must exist under the given paths on every
executor.
"""

from __future__ import annotations

import gc
import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from vitrine.llm.common import in_chunks
from vitrine.session import measured, stored

BYTE_BPE, PIECE_BPE = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
#: A space or line break after a character that is no white space begins a stretch, and a mark after a letter.
MARKS, LETTER = ".,;:!?", r"[^\W\d_²³¹]"
STRETCH = re.compile(rf"(?:[ \n]\s*+)?(?:[^\w\s]|[\d_²³¹]|[^\S \n]\s*+|{LETTER}++(?![{MARKS}]))*+{LETTER}*+")
#: Pairs of ids sent to all tasks, at most; 17 bytes each.
FREQUENT = 1_000_000
#: What a task remembers of stretches, in stretches and in their characters.
KNOWN, KNOWN_CHARS = 200_000, 4_000_000
#: Links looked at together.
LINKS_AT_ONCE = 1 << 18
SPACE = "▁"
NUMBERS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def _byte_of_char() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 characters stand for themselves, the other bytes follow from U+0100 on."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    return {**{chr(b): b for b in plain}, **{chr(256 + n): b for n, b in enumerate(sorted(set(range(256)) - set(plain)))}}


class Aligner:
    """Both tokenizers and what is known of the stretches seen; one per task."""

    def __init__(self, byte_bpe: str, piece_bpe: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(byte_bpe), sentencepiece.SentencePieceProcessor(model_file=piece_bpe)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        alphabet = _byte_of_char()
        known = {i: bytes(map(alphabet.get, t)) if set(t) <= alphabet.keys() else t.encode() for t, i in self.a.get_vocab().items()}
        self.a_bytes = [known.get(i, b"") for i in range(max(known) + 1)]
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(names)]
        self.gap, self.width = names.index(SPACE) if SPACE in names else None, len(names)
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in own]) for own in (self.a_bytes, self.b_bytes))
        self.most = max(len(self.a_bytes), len(self.b_bytes))
        self.numerals = [f"{i}{mark}" for mark in ",|;" for i in range(self.most)]
        prefixed = json.loads(self.a.to_str())["pre_tokenizer"] or {}
        self.local = (prefixed.get("type") == "ByteLevel" and not prefixed.get("add_prefix_space") and self.gap is not None
                      and not any("\n" in p or re.search(rf"[^{SPACE}]{SPACE}|{LETTER}[{MARKS}]", p) for p in names))
        self.kind = np.int32 if len(self.a_bytes) * self.width < 1 << 31 else np.int64
        self.cleared = 0
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.cleared, self.chars, self.groups = self.cleared + 1, 0, []
        #: Per stretch: tokens of both sides, groups and links (the first -1 where bytes differ); the links of all in a row.
        self.sizes, self.links = np.empty((0, 4), np.int64), np.empty(0, self.kind)

    def stretches(self, text: str) -> list[str]:
        return [s for s in STRETCH.findall(" " + text) if s] if self.local else [" " + text]

    def ids(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Numbers of the stretches of each text, by which `sizes`, `links` and `groups` are found until the next call."""
        if len(self.known) > KNOWN or self.chars > KNOWN_CHARS:
            self.clear()
        new = [s for s in set(chain.from_iterable(texts)) if s not in self.known]
        gc.disable()  # millions of small objects, none of them in a cycle
        for part in in_chunks([len(s) for s in new], 1 << 17):
            self._learn(new[part])
        gc.enable()
        find = self.known.__getitem__
        return [np.fromiter(map(find, own), np.int64, len(own)) for own in texts]

    def _learn(self, new: list[str]) -> None:
        raws = [s.encode("utf-8", "surrogatepass") for s in new]
        a = self.a.encode_batch(new, add_special_tokens=False)
        # sentencepiece puts a space before what it is given: that of the stretch, or one to be taken off again. A line break
        # between that one and another first character keeps them apart.
        given = [s[1:] if s[0] == " " else s if s[0] == "\n" else "\n" + s for s in new]
        b_ids = self.b.encode(given, out_type=int)
        a_ids = [x.ids for x in a]
        for i, s in enumerate(new):
            if s == " ":
                b_ids[i] = [self.gap]
            elif s[0] != " ":
                b_ids[i] = b_ids[i][1 if s[0] == "\n" else 2:] if b_ids[i][:1] == [self.gap] else []
        if not self._sound(raws, a_ids, self.a_bytes, self.a_sizes) or not self._sound(raws, b_ids, self.b_bytes, self.b_sizes):
            sound = [all(b"".join(map(pieces.__getitem__, own)) == raw for own, pieces in ((x, self.a_bytes), (y, self.b_bytes)))
                     for x, y, raw in zip(a_ids, b_ids, raws)]
            for i in (i for i, ok in enumerate(sound) if not ok):
                self.known[new[i]] = len(self.groups)
                self.groups.append("")
                self.sizes = np.append(self.sizes, [[-1, 0, 0, 0]], axis=0)
            order = [i for i, ok in enumerate(sound) if ok]
            new, raws, a_ids, b_ids = ([x[i] for i in order] for x in (new, raws, a_ids, b_ids))
        self._align(new, raws, a_ids, b_ids)
        self.chars += sum(map(len, new))

    @staticmethod
    def _sound(raws: list[bytes], ids: list[list[int]], pieces: list[bytes], sizes: np.ndarray) -> bool:
        """Whether the bytes of the tokens are those of the stretches, of all and of each."""
        flat = list(chain.from_iterable(ids))
        ends = np.cumsum(np.append(0, sizes[np.array(flat, np.int64)]))[np.cumsum([len(x) for x in ids])]
        return b"".join(map(pieces.__getitem__, flat)) == b"".join(raws) and bool((ends == np.cumsum([len(x) for x in raws])).all())

    def _align(self, new: list[str], raws: list[bytes], a_ids: list[list[int]], b_ids: list[list[int]]) -> None:
        """Align stretches side by side, at byte offsets in all of them together."""
        if not new:
            return
        sizes = np.cumsum([0, *map(len, raws)])
        n_a, n_b = np.array([len(x) for x in a_ids]), np.array([len(x) for x in b_ids])
        a, b = (np.array(list(chain.from_iterable(x)), np.int64) for x in (a_ids, b_ids))
        # The tokens' bytes are the text's, so that their lengths give the ends.
        a_ends, b_ends = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        cuts, both = np.union1d(a_ends, b_ends), np.intersect1d(a_ends, b_ends, assume_unique=True)
        # Every piece between cuts lies in one token of each side.
        links = a[np.searchsorted(a_ends, cuts)] * self.width + b[np.searchsorted(b_ends, cuts)]
        n_links, n_groups = (np.diff(np.searchsorted(x, sizes, side="right")) for x in (cuts, both))
        # The ids in the order of the groups, A before B, each with the mark that follows it.
        a_cut, b_cut = (np.append(0, np.searchsorted(x, both) + 1) for x in (a_ends, b_ends))
        a_group, b_group = np.searchsorted(both, a_ends), np.searchsorted(both, b_ends)
        shown = np.empty(len(a) + len(b), np.int64)
        shown[np.arange(len(a)) + b_cut[a_group]] = a + np.where(a_ends == both[a_group], self.most, 0)
        shown[np.arange(len(b)) + a_cut[b_group + 1]] = b + np.where(b_ends == both[b_group], 2 * self.most, 0)
        numerals, of = list(map(self.numerals.__getitem__, shown.tolist())), np.cumsum([0, *(n_a + n_b)]).tolist()
        self.known.update(zip(new, range(len(self.groups), len(self.groups) + len(new))))
        self.groups += ["".join(numerals[i:j]) for i, j in zip(of, of[1:])]
        self.sizes = np.concatenate([self.sizes, np.stack([n_a, n_b, n_groups, n_links], axis=1)])
        self.links = np.append(self.links, links.astype(self.kind))

    def batches(self, texts: pa.Array) -> Iterator[tuple[slice, list[np.ndarray]]]:
        """Slices of a column of texts, with the stretch numbers of each text; none where a text has no tokens."""
        for part in in_chunks(pc.fill_null(pc.binary_length(texts), 0).to_pylist(), 1 << 20):
            found = self.ids([self.stretches(t) if (t := x.as_py()) else [] for x in texts[part.start:part.stop]])
            sound = self.sizes[:, 0] >= 0
            yield part, [own if len(own) and sound[own].all() else own[:0] for own in found]


def aligned(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", byte_bpe: str = BYTE_BPE, piece_bpe: str = PIECE_BPE,
            digest: bool = False) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, `groups` (with `digest` their SHA-256) and `links`, an array of A id times the
    number of B ids plus B id."""
    label = "groups_sha256" if digest else "groups"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Aligner(byte_bpe, piece_bpe)
        for batch in batches:
            for part, found in own.batches(batch.column(1)):
                flat = np.concatenate([np.empty(0, np.int64), *found])
                ends, sizes = np.cumsum(own.sizes[:, 3]), own.sizes[flat]
                cut = np.cumsum([0, *map(len, found)])
                totals = np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(sizes, axis=0)])[cut]
                # The links of all stretches one after the other.
                n = sizes[:, 3]
                links = own.links[np.arange(n.sum()) + np.repeat(ends[flat] - np.cumsum(n), n)]
                texts = ["".join(map(own.groups.__getitem__, x.tolist()))[:-1] for x in found]
                if digest:
                    texts = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in texts]
                lists = pa.ListArray.from_arrays(pa.array(totals[:, 3], pa.int32()), pa.array(links))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[part.start:part.stop], *(pa.array(x) for x in np.diff(totals, axis=0).T.copy()), pa.array(texts, pa.string()), lists],
                    names=["doc_id", *NUMBERS[:4], label, "links"])
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind, number = rows.schema["doc_id"].dataType.simpleString(), "int" if Aligner(byte_bpe, piece_bpe).kind is np.int32 else "long"
    return rows.mapInArrow(run, f"doc_id {kind}, {', '.join(f'{c} long' for c in NUMBERS[:4])}, {label} string, links array<{number}>")


def _link_slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for part in in_chunks(pc.list_value_length(batch.column("links")).to_pylist(), LINKS_AT_ONCE):
        yield batch.slice(part.start, part.stop - part.start)


def pair_counts(links: DataFrame, width: int) -> DataFrame:
    """(pair, n, best): how many links of the corpus hold each pair of ids, and whether no other A id has more with that B
    id. `width` is the number of B ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for links in (own for batch in batches for own in _link_slices(batch)):
            pair, n = np.unique(np.asarray(links.column("links").flatten()), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pair, pa.int64()), pa.array(n, pa.int64())], names=["pair", "n"])
    counted = stored(links.select("links").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    b = F.col("pair") % width
    most = counted.groupBy(b.alias("b")).agg(F.max("n").alias("most"))
    return counted.withColumn("b", b).join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def align(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", byte_bpe: str = BYTE_BPE, piece_bpe: str = PIECE_BPE,
          frequent: int = FREQUENT, digest: bool = False) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, and `groups`, the aligned ids as
    `a1,a2|b1;a3|b2,b3` (empty without tokens); with `digest` its SHA-256 `groups_sha256` (lower-case hex) in its place."""
    width = len(Aligner(byte_bpe, piece_bpe).b_bytes)
    label = "groups_sha256" if digest else "groups"
    made, seen = measured(aligned(docs, doc_id, text, byte_bpe, piece_bpe, digest).withColumn("row", F.monotonically_increasing_id()),
                          "aligned", F.sum("n_links").alias("links"))
    pairs = stored(pair_counts(made, width), "scored-pairs")
    least = max((seen["links"] or 0) // frequent + 1, 1)
    known = pairs.filter(F.col("n") >= least).toArrow()  # at most `frequent` rows, whatever the corpus
    columns = [known.column(c).to_numpy() for c in ("pair", "n", "best")]
    order = np.argsort(columns[0])
    shared = docs.sparkSession.sparkContext.broadcast([c[order] for c in columns])

    shape = ["row", *(c for c in made.columns if c not in ("row", "links"))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = shared.value
        for batch in (own for b in batches for own in _link_slices(b)):
            lists = batch.column("links")
            links, cut = np.asarray(lists.flatten()).astype(np.int64), np.append(0, np.cumsum(np.asarray(pc.list_value_length(lists))))
            at = np.minimum(np.searchsorted(pair, links), max(len(pair) - 1, 0))
            hit = pair[at] == links if len(pair) else np.zeros(len(links), bool)
            of = np.repeat(np.arange(len(cut) - 1), np.diff(cut))
            sums = [np.diff(np.append(0, np.cumsum(np.where(hit, x[at] if len(pair) else 0, 0)))[cut].astype(np.int64)) for x in (best, n)]
            # Row and pair of the links left over, each with its number of occurrences.
            rest = np.stack([of[~hit], links[~hit]], axis=1)
            rest, times = np.unique(rest, axis=0, return_counts=True) if len(rest) else (rest, np.empty(0, np.int64))
            rare = pa.StructArray.from_arrays([pa.array(rest[:, 1]), pa.array(times, pa.int64())], names=["pair", "times"])
            ends = np.searchsorted(rest[:, 0], np.arange(len(cut)))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in shape), *(pa.array(x) for x in sums), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rare)],
                names=[*shape, "n_best", "count_sum", "rare"])
    types = ", ".join(f"{c} {made.schema[c].dataType.simpleString()}" for c in shape)
    scores, seen = measured(made.mapInArrow(run, f"{types}, n_best long, count_sum long, rare array<struct<pair: long, times: long>>"),
                            "scores", F.sum(F.size("rare")).alias("rare"))
    if not seen["rare"]:
        return scores.select("doc_id", *NUMBERS, label)
    left = scores.select("row", F.explode("rare").alias("r")).select("row", "r.*").join(pairs.filter(F.col("n") < least), "pair")
    extra = left.groupBy("row").agg(F.sum(F.col("times") * F.col("best").cast("long")).alias("x_best"), F.sum(F.col("times") * F.col("n")).alias("x_sum"))
    return scores.join(extra, "row", "left").select(
        "doc_id", *NUMBERS[:4], (F.col("n_best") + F.coalesce("x_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("x_sum", F.lit(0))).alias("count_sum"), label)


def digests(docs: DataFrame, **options) -> DataFrame:
    """As `align`, with the digest of the groups: nothing as long as the texts is written but the links."""
    return align(docs, digest=True, **options)
