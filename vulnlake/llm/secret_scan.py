"""Operator 2: secret scans with a random forest that removes false positives.

Candidates are published formats, blocks of private keys, passwords in URLs, values of assignments and long tokens. Features: length, character transitions (changes of class, and
how unusual the pairs of characters are in the corpus), coverage by the corpus' frequent words, the path, and the
neighbouring words. The forest is trained by Spark from labelled findings and then applied, as small arrays, where the
texts are. It decides every finding but those in a published format.

Labelled findings are a table of the caller, or else the rule `labelled` as a weak labeller. To both come planted findings
(`planted`): values of known kind, written into surroundings of the corpus, among them those that the rule takes for secrets.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vulnlake.llm.arrays import as_bytes, slices
from vulnlake.llm.secret_examples import examples
from vulnlake.llm.tables import cut_lineage, pick
from vulnlake.session import new_dir

# Bytes from which a token is a candidate, and from which the value of an assignment is one.
TOKEN = 16
VALUE = 8
# The dictionary holds the words of the corpus with so many letters that occur more than once and at least once in so many bytes, a
# share that means the same at every size. At most WORD_EVERY / 4 words do, whatever the size, so that bounds what reaches the driver.
WORD_EVERY = 1_000_000
# Every pair of characters counts as seen so often beforehand, so that few texts tell little about a pair.
PAIR_PRIOR = 16.0
SHORTEST_WORD, LONGEST_WORD = 3, 16
# About so many labelled findings train the forest, chosen by a hash of their document and place.
SAMPLE = 20_000
# About so many places of the corpus, chosen likewise, get one planted finding of every kind.
PLACES = 1_000
TREES, DEPTH, SEED = 30, 8, 11
DECISION = 0.5
MASK = b"[SECRET]"

# Words that tell of secrets, and of examples, in names, neighbours and paths.
SECRET_WORDS = ("api", "apikey", "auth", "bearer", "credential", "key", "pass", "passphrase", "passwd", "password", "private", "pwd", "secret", "token")
EXAMPLE_WORDS = ("changeme", "demo", "doc", "docs", "dummy", "example", "fake", "mock", "placeholder", "sample", "test", "tests", "xxx")
# Published formats of credentials, by kind.
FORMATS = {
    "aws": re.compile(rb"A[KS]IA[0-9A-Z]{16}"),
    "digitalocean": re.compile(rb"do[opr]_v1_[0-9a-f]{64}"),
    "github": re.compile(rb"gh[pousr]_[0-9A-Za-z]{36}|github_pat_[0-9A-Za-z_]{22,}"),
    "gitlab": re.compile(rb"gl(?:pat|dt|rt|ptt)-[0-9A-Za-z_\-]{20,}"),
    "google": re.compile(rb"AIza[0-9A-Za-z_\-]{35}|ya29\.[0-9A-Za-z_\-]{20,}|GOCSPX-[0-9A-Za-z_\-]{28}"),
    "huggingface": re.compile(rb"hf_[0-9A-Za-z]{34}"),
    "jwt": re.compile(rb"eyJ[0-9A-Za-z_\-]{10,}\.[0-9A-Za-z_\-]{10,}\.[0-9A-Za-z_\-]{10,}"),
    "npm": re.compile(rb"npm_[0-9A-Za-z]{36}"),
    "openai": re.compile(rb"sk-(?=[A-Za-z_\-]*[0-9])[0-9A-Za-z_\-]{20,}"),
    "pypi": re.compile(rb"pypi-[0-9A-Za-z_\-]{50,}"),
    "sendgrid": re.compile(rb"SG\.[0-9A-Za-z_\-]{22}\.[0-9A-Za-z_\-]{43}"),
    "slack": re.compile(rb"xox[abeprs]-[0-9A-Za-z\-]{10,}|xapp-[0-9A-Za-z\-]{10,}"),
    "stripe": re.compile(rb"(?:[rs]k_(?:live|test)|whsec)_[0-9A-Za-z]{16,}"),
}
PUBLISHED = re.compile(rb"(?<![0-9A-Za-z_])(?:%s)(?![0-9A-Za-z_])" % b"|".join(p.pattern for p in FORMATS.values()))
FEATURES = (
    "length", "digits", "uppers", "lowers", "hex", "changes", "surprise", "entropy", "coverage",
    "assigned", "quoted", "name_secret", "near_secret", "near_example", "path_example", "path_depth", "path_digits",
    "in_url", "signs", "blanks", "stands_for", "holds_example", "name_words", "parts",
)

LONG_TOKEN = re.compile(rb"[A-Za-z0-9+/_\-]{%d,}(?:\.[A-Za-z0-9_\-]{10,}){0,2}={0,2}" % TOKEN)
SIGN = re.compile(rb"(?:=>|[:=]{1,2})[ \t]*")
PLAIN = re.compile(rb"([\"']?)([A-Za-z0-9+/_\-.]{%d,})" % VALUE)
QUOTED = re.compile(rb"([\"'`])((?:(?!\1)[^\\\n]|\\.)*)\1")
BLANK = re.compile(rb"\s")
AFTER_VALUE = b".,;:)]}>\"'`"
SCHEME = re.compile(rb"[A-Za-z][A-Za-z0-9+.\-]*://")
NAME_BEFORE = re.compile(rb"([A-Za-z][A-Za-z0-9_\-]{1,40})[\"']?[ \t]*$")
CAMEL = re.compile(rb"(?<=[a-z0-9])(?=[A-Z])")
# The password of scheme://user:password@host; and the name that such a finding has.
IN_URL = re.compile(rb"://[^\s/:@]*:([^\s/]+)@")
URL_NAME = b"url_password"
PEM_BEGIN = re.compile(rb"-----BEGIN [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----")
PEM_END = re.compile(rb"-----END [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----")
PEM_BODY = re.compile(rb"(?:(?:\\n|\s)*[A-Za-z0-9+/=\\]{16,})*(?:\s+[A-Za-z0-9+/]*={1,2})?")
# Values that stand for something else: masks, variables, expressions.
STANDS_FOR = re.compile(rb"[*xX.]+|\$?\{.*\}?|\$\(.*|\$[A-Z_][A-Z0-9_]*|%\(?\w+\)?[sd%]?|<.*|[A-Za-z_][\w.]*[(\[].*", re.S)
WORD = re.compile(rb"[a-z]+")
# Words of at least three letters between other signs: many of them make an identifier or a phrase.
PART = re.compile(rb"(?<![0-9A-Za-z])[A-Za-z]{3,}(?![0-9A-Za-z])")


# ---- candidates --------------------------------------------------------------------------------
@dataclass
class Candidate:
    start: int
    end: int
    name: bytes
    quoted: bool


def _secret_name(name: bytes) -> bool:
    return bool(set(WORD.findall(CAMEL.sub(b"_", name).lower())) & _SECRET)


def _key_blocks(text: bytes) -> Iterator[Candidate]:
    """Private keys with their first and last lines; without a last line as far as there is base64."""
    at, last = 0, None
    while begin := PEM_BEGIN.search(text, at):
        if last is None or 0 <= last[0] < begin.end():
            m = PEM_END.search(text, begin.end())
            last = m.span() if m else (-1, -1)
        following = PEM_BEGIN.search(text, begin.end())
        whole = last[0] >= 0 and not (following and following.start() < last[0])
        at = last[1] if whole else PEM_BODY.match(text, begin.end()).end()
        yield Candidate(begin.start(), at, b"", False)


def _secret_values(text: bytes) -> Iterator[Candidate]:
    """Values of names that tell of a secret: up to the closing quote, without quotes up to white space."""
    at = run = tail = 0
    while sign := SIGN.search(text, at):
        at = sign.end()
        name = NAME_BEFORE.search(text, max(0, sign.start() - 80), sign.start())
        if not name or not _secret_name(name[1]):
            continue
        m = QUOTED.match(text, at)
        if m:
            start, end = m.span(2)
        else:
            if at >= run:  # the end of what has no blank is looked for once, however many signs are in it
                blank = BLANK.search(text, at)
                run = tail = blank.start() if blank else len(text)
                while tail > at and text[tail - 1] in AFTER_VALUE:
                    tail -= 1
            start, end = at + (text[at : at + 1] in _QUOTES), tail
        if end - start >= VALUE and not SCHEME.match(text, start, end):
            yield Candidate(start, end, name[1], text[start - 1 : start] in _QUOTES)
            at = end


def _plain_values(text: bytes) -> Iterator[Candidate]:
    at = 0
    while sign := SIGN.search(text, at):
        at = sign.end()
        m = PLAIN.match(text, at)
        name = m and NAME_BEFORE.search(text, max(0, sign.start() - 80), sign.start())
        if m:
            at = m.end()
        if name:
            yield Candidate(m.start(2), m.end(2), name[1], bool(m[1]))


def _unnamed(text: bytes, pattern: re.Pattern[bytes], at: int, end: int) -> Iterator[Candidate]:
    for m in pattern.finditer(text, at, end):
        yield Candidate(m.start(), m.end(), b"", text[m.start() - 1 : m.start()] in _QUOTES)


def _joined(found: list[Candidate], more: Iterable[Candidate]) -> list[Candidate]:
    """All of `found` and, of others that do not overlap each other, those that touch none of them, in order."""
    starts = [c.start for c in found]
    free = []
    for c in more:
        k = bisect_left(starts, c.end)
        if not (k and found[k - 1].end > c.start):
            free.append(c)
    return sorted(found + free, key=lambda c: c.start) if free else found


def candidates(text: bytes) -> list[Candidate]:
    """Places of a text, in order, none inside another. An assignment needs a name before it."""
    found = list(_key_blocks(text))
    found = _joined(found, _secret_values(text))
    found = _joined(found, (Candidate(m.start(1), m.end(1), URL_NAME, False) for m in IN_URL.finditer(text)))
    found = _joined(found, _unnamed(text, PUBLISHED, 0, len(text)))
    found = _joined(found, _plain_values(text))
    gaps = zip([0, *(c.end for c in found)], [*(c.start for c in found), len(text)])
    return _joined(found, [c for a, b in gaps if b - a >= TOKEN for c in _unnamed(text, LONG_TOKEN, a, b)])


def published(value: bytes) -> str | None:
    """Kind of a value in a published format."""
    if PEM_BEGIN.match(value):
        return "pem"
    return next((kind for kind, pattern in FORMATS.items() if pattern.fullmatch(value)), None)


def labelled(value: bytes, name: bytes) -> int:
    """Weak label of a finding: 1 for a published format, for a password in a URL, and for a value with letters and digits under a name
    that tells of a secret; not for values that stand for something else."""
    if published(value):
        return 1
    lowered = value.lower()
    if STANDS_FOR.fullmatch(value) or any(w in lowered for w in _EXAMPLE_LONG):
        return 0
    if name == URL_NAME:
        return int(lowered not in _SECRET)
    mixed = bool(re.search(rb"\d", value)) and bool(re.search(rb"[A-Za-z]", value)) and len(value) >= 12
    return int(_secret_name(name) and mixed)


_QUOTES = (b'"', b"'", b"`")
_SECRET = {w.encode() for w in SECRET_WORDS}
_EXAMPLE = {w.encode() for w in EXAMPLE_WORDS}
_EXAMPLE_LONG = tuple(w for w in _EXAMPLE if len(w) > 4)


# ---- corpus statistics -------------------------------------------------------------------------
@dataclass
class Corpus:
    """Frequent words, and surprise in bits of one byte after another over the whole corpus."""

    words: frozenset[bytes]
    surprise: np.ndarray


def corpus_statistics(docs: DataFrame, text: str = "text") -> Corpus:
    """Counts over all documents; what reaches the driver is bounded by WORD_EVERY and a table of 256 x 256 counts."""
    own = pick(docs, text).toDF("text")
    size = own.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    letters = F.explode(F.split(F.lower(F.coalesce("text", F.lit(""))), "[^a-z]+")).alias("word")
    counted = own.select(letters).where(F.length("word").between(SHORTEST_WORD, LONGEST_WORD)).groupBy("word").agg(F.count("*").alias("n"))
    frequent = counted.where((F.col("n") > 1) & (F.col("n") * WORD_EVERY >= F.lit(size))).select("word").collect()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, np.int64)
        for batch in batches:
            texts = as_bytes(batch.column(0))
            for i, j in slices([len(t) for t in texts]):
                data = np.frombuffer(b"\n".join(texts[i:j]), np.uint8)
                for at in range(0, len(data) - 1, 1 << 20):
                    part = data[at : at + (1 << 20) + 1].astype(np.int64)
                    total += np.bincount(part[:-1] << 8 | part[1:], minlength=1 << 16)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["pair", "n"])

    pairs = own.mapInArrow(run, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n")).collect()
    counts = np.full(1 << 16, PAIR_PRIOR)
    for r in pairs:
        counts[r["pair"]] += r["n"]
    counts = counts.reshape(256, 256)
    return Corpus(frozenset(r["word"].encode() for r in frequent), -np.log2(counts / counts.sum(axis=1, keepdims=True)))


@cache
def _beginnings(words: frozenset[bytes]) -> frozenset[bytes]:
    return frozenset(w[:SHORTEST_WORD] for w in words)


def coverage(value: bytes, words: frozenset[bytes]) -> float:
    """Share of the letters and digits that lie in dictionary words, the longest first from the left."""
    lowered, covered, i = value.lower(), 0, 0
    begins = _beginnings(words)
    while i < len(lowered):
        if lowered[i : i + SHORTEST_WORD] in begins:
            for n in range(min(LONGEST_WORD, len(lowered) - i), SHORTEST_WORD - 1, -1):
                if lowered[i : i + n] in words:
                    covered += n
                    i += n
                    break
            else:
                i += 1
        else:
            i += 1
    return covered / len(lowered)


# ---- features ----------------------------------------------------------------------------------
_KIND = np.zeros(256, np.int8)
_KIND[ord("0") : ord("9") + 1] = 1
_KIND[ord("A") : ord("Z") + 1] = 2
_KIND[ord("a") : ord("z") + 1] = 3
_HEX = np.zeros(256, bool)
_HEX[list(b"0123456789abcdefABCDEF")] = True


def features(text: bytes, c: Candidate, path: str, corpus: Corpus) -> list[float]:
    """One number for each of FEATURES, from the whole value."""
    value = text[c.start : c.end]
    data = np.frombuffer(value, np.uint8)
    kind, n = _KIND[data], len(value)
    counts = np.bincount(data)
    share = counts[counts > 0] / n
    near = text[max(0, c.start - 60) : c.start].lower()
    around = set(WORD.findall(near)[-4:]) | set(WORD.findall(text[c.end : c.end + 30].lower())[:2])
    name = set(WORD.findall(c.name.lower()))
    parts = set(WORD.findall(path.lower().encode()))
    return [
        float(n), float((kind == 1).mean()), float((kind == 2).mean()), float((kind == 3).mean()), float(_HEX[data].all()),
        float((kind[1:] != kind[:-1]).mean()) if n > 1 else 0.0,
        float(corpus.surprise[data[:-1], data[1:]].mean()) if n > 1 else 0.0,
        float(-(share * np.log2(share)).sum()), coverage(value, corpus.words),
        float(bool(c.name)), float(c.quoted), float(_secret_name(c.name)), float(bool(around & _SECRET)),
        float(bool((around | name) & _EXAMPLE)), float(bool(parts & _EXAMPLE)), float(path.count("/")), float(sum(ch.isdigit() for ch in path)),
        float(c.name == URL_NAME), float((kind == 0).mean()), float((data == 32).mean()), float(bool(STANDS_FOR.fullmatch(value))),
        float(any(w in value.lower() for w in _EXAMPLE_LONG)), float(len(WORD.findall(CAMEL.sub(b"_", c.name).lower()))),
        float(len(PART.findall(value))),
    ]


# ---- forest ------------------------------------------------------------------------------------
@dataclass
class Forest:
    """Trees as arrays: a node's feature (-1 in leaves), threshold, children, and its probability of a secret."""

    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]

    def probability(self, rows: np.ndarray) -> np.ndarray:
        total = np.zeros(len(rows))
        for feature, threshold, left, right, share in self.trees:
            at = np.zeros(len(rows), np.int64)
            while True:
                inner = np.flatnonzero(feature[at] >= 0)
                if not len(inner):
                    break
                own = at[inner]
                at[inner] = np.where(rows[inner, feature[own]] <= threshold[own], left[own], right[own])
            total += share[at]
        return total / len(self.trees)


def train(findings: DataFrame, trees: int = TREES, depth: int = DEPTH) -> Forest | None:
    """The forest of a table with features (array) and label (0 or 1); None unless both labels occur.

    Spark trains it and stores it in the shared folder, from where its nodes are read: at most trees * 2 ** (depth + 1) rows.
    """
    spark = findings.sparkSession
    if findings.agg(F.count_distinct("label")).first()[0] < 2:
        return None
    rows = findings.select(array_to_vector(F.col("features")).alias("features"), F.col("label").cast("double").alias("label"))
    model = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=SEED, featureSubsetStrategy="sqrt").fit(rows)
    path = new_dir(spark, "secret-forest")
    model.write().save(path)
    stored: dict[int, list] = {}
    for r in spark.read.parquet(f"{path}/data").collect():
        stored.setdefault(r["treeID"], []).append(r["nodeData"])
    out = []
    for nodes in stored.values():
        size = max(n["id"] for n in nodes) + 1
        feature, threshold = np.full(size, -1), np.zeros(size)
        left, right, share = np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros(size)
        for n in nodes:
            i, stats = n["id"], n["impurityStats"]
            share[i] = stats[1] / sum(stats)
            if n["leftChild"] >= 0:
                feature[i], threshold[i] = n["split"]["featureIndex"], n["split"]["leftCategoriesOrThreshold"][0]
                left[i], right[i] = n["leftChild"], n["rightChild"]
        out.append((feature, threshold, left, right, share))
    return Forest(out)


def findings(docs: DataFrame, corpus: Corpus) -> DataFrame:
    """doc_id, start, features, label of all candidates; `docs` has doc_id, text and path."""
    shared = docs.sparkSession.sparkContext.broadcast(corpus)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, starts, values, labels = [], [], [], []
            paths = batch.column(2).to_pylist()
            for row, text in enumerate(as_bytes(batch.column(1))):
                for c in candidates(text):
                    rows.append(row)
                    starts.append(c.start)
                    values.append(features(text, c, paths[row] or "", shared.value))
                    labels.append(labelled(text[c.start : c.end], c.name))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(starts, pa.int64()), pa.array(values, pa.list_(pa.float64())), pa.array(labels, pa.int32())],
                names=["doc_id", "start", "features", "label"],
            )

    return docs.select("doc_id", "text", "path").mapInArrow(run, f"doc_id {kind}, start bigint, features array<double>, label int")


@dataclass
class Scanner:
    corpus: Corpus
    forest: Forest | None

    def scan(self, text: bytes, path: str) -> list[tuple[Candidate, float]]:
        """All candidates with the probability of a secret: 1 for a published format, for all others the forest's alone. Without a
        forest, the rule decides."""
        found = candidates(text)
        if not found:
            return []
        if self.forest is None:
            return [(c, float(labelled(text[c.start : c.end], c.name))) for c in found]
        rows = np.array([features(text, c, path, self.corpus) for c in found])
        format_ = np.array([published(text[c.start : c.end]) is not None for c in found])
        return list(zip(found, np.where(format_, 1.0, self.forest.probability(rows)).tolist()))


def learn(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str = "source", sample: int = SAMPLE,
    labels: DataFrame | None = None, places: int = PLACES,
) -> Scanner:
    """Corpus statistics over all documents, and a forest from about `sample` findings of each label and from planted ones.

    `labels` has doc_id, start, label (0 or 1): findings that people have judged, which are learned from in place of the weak labels; those
    at no candidate's place are of no use, and of several labels of one place the larger one counts. `places` = 0 plants none.
    Documents whose crc32(id) modulo 3 is 1 are never learned from, so they can be used to measure. A table without documents, or findings
    of one label only, give no forest.
    """
    own = pick(docs, doc_id, text, path).toDF("doc_id", "text", "path")
    corpus = corpus_statistics(own)
    learning = own.where(~held_out(F.col("doc_id")))
    found = findings(learning, corpus)
    if labels is not None:
        judged = labels.groupBy("doc_id", "start").agg(F.max("label").cast("int").alias("label"))
        found = found.drop("label").join(judged, ["doc_id", "start"])
    found = cut_lineage(found, "secret-findings")
    sizes = {r["label"]: r["n"] for r in found.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = F.coalesce(*(F.when(F.col("label") == k, int((1 << 30) * min(1.0, sample / n))) for k, n in sizes.items()), F.lit(0))
    chosen = found.where(F.pmod(F.xxhash64("doc_id", "start"), F.lit(1 << 30)) < share).select("features", "label")
    if places:
        chosen = chosen.unionByName(planted(learning, corpus, places).select("features", "label"))
    return Scanner(corpus, train(cut_lineage(chosen, "secret-sample")))


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning; those without an id are, too."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(True))


def planted(docs: DataFrame, corpus: Corpus, places: int = PLACES, seed: int = SEED) -> DataFrame:
    """kind, features, label, ruled: findings of known kind at about `places` places of the texts, one of every kind at each.

    `docs` has doc_id, text and path. Documents are chosen by a hash of their id; where there are fewer than `places`, each is used
    several times. Features come from the 200 bytes around a place, which hold all words they look at. `ruled` is the weak label.
    """
    n = docs.count()
    chosen = docs.where(F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30)) < int((1 << 30) * min(1.0, places / max(n, 1))))
    rounds = max(1, places // max(n, 1))
    shared = docs.sparkSession.sparkContext.broadcast(corpus)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = sorted(shared.value.words)
        for batch in batches:
            ids, paths, out = batch.column(0).to_pylist(), batch.column(2).to_pylist(), []
            for row, text in enumerate(as_bytes(batch.column(1))):
                for turn in range(rounds):
                    rng = random.Random(f"{seed}:{ids[row]}:{turn}")
                    for kind, before, value, after, label in examples(rng, words):
                        at = rng.randrange(len(text) + 1)
                        head, tail = text[max(0, at - 100) : at] + b" " + before, after + b" " + text[at : at + 100]
                        whole = head + value + tail
                        hit = next((c for c in candidates(whole) if c.start <= len(head) < c.end), None)
                        if hit:  # what is no candidate never comes before the forest
                            own = features(whole, hit, paths[row] or "", shared.value)
                            out.append((kind, own, label, labelled(whole[hit.start : hit.end], hit.name)))
            columns = list(zip(*out)) if out else [[]] * 4
            types = [pa.string(), pa.list_(pa.float64()), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["kind", "features", "label", "ruled"])

    return chosen.select("doc_id", "text", "path").mapInArrow(run, "kind string, features array<double>, label int, ruled int")


def scan(docs: DataFrame, scanner: Scanner, doc_id: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """doc_id, start, length, kind, sha256, score, secret: one row per candidate, in bytes of the UTF-8 text.

    `secret` is the decision that the score is at least DECISION; the rest are false positives, cleared by the forest. The value itself is not
    returned, only its hash. A null text has no candidates, a null path counts as empty, repeated rows repeat their findings.
    """
    own = pick(docs, doc_id, text, path).toDF("doc_id", "text", "path")
    shared = docs.sparkSession.sparkContext.broadcast(scanner)
    kind = own.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, out = [], []
            paths = batch.column(2).to_pylist()
            for row, own_text in enumerate(as_bytes(batch.column(1))):
                for c, p in shared.value.scan(own_text, paths[row] or ""):
                    value = own_text[c.start : c.end]
                    rows.append(row)
                    out.append((c.start, c.end - c.start, published(value) or "generic", hashlib.sha256(value).hexdigest(), p, p >= DECISION))
            columns = list(zip(*out)) if out else [[]] * 6
            types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), *(pa.array(c, t) for c, t in zip(columns, types))],
                names=["doc_id", "start", "length", "kind", "sha256", "score", "secret"],
            )

    return own.mapInArrow(run, f"doc_id {kind}, start bigint, length bigint, kind string, sha256 string, score double, secret boolean")


def masked(text: bytes, found: list[tuple[Candidate, float]]) -> bytes:
    """The text with MASK in place of every secret."""
    at, out = 0, []
    for c, p in found:
        if p >= DECISION:
            out += [text[at : c.start], MASK]
            at = c.end
    return b"".join([*out, text[at:]])


def mask(docs: DataFrame, scanner: Scanner, text: str = "text", path: str = "source") -> DataFrame:
    """The columns of `docs`, of whatever names, with MASK in place of every secret.

    Null stays null, empty texts stay empty, long ones are read whole; repeated rows are masked alike; an empty table gives an empty one.
    """
    columns = docs.columns
    shared = docs.sparkSession.sparkContext.broadcast(scanner)
    schema = ", ".join(f"`c{i}` {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(columns))
    at, where = columns.index(text), columns.index(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, valid = batch.column(where).to_pylist(), batch.column(at).is_valid().to_pylist()
            out = [
                masked(own, shared.value.scan(own, p or "")).decode() if there else None
                for own, p, there in zip(as_bytes(batch.column(at)), paths, valid)
            ]
            arrays = [batch.column(i) for i in range(len(columns))]
            arrays[at] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(arrays, names=[f"c{i}" for i in range(len(columns))])

    renamed = docs.toDF(*(f"c{i}" for i in range(len(columns))))
    return renamed.mapInArrow(run, schema).toDF(*columns)
