"""Secrets in texts: candidates by shape, false positives removed by a random forest.

Candidates are key blocks, values assigned to a name that speaks of a credential, and runs of
``MIN_RUN`` or more characters of ``A-Za-z0-9+/_-`` with a digit. The forest judges every candidate, whole and also where
it overlaps others, by its length, kinds of characters and changes between them, how usual its character transitions are
in the corpus, how much of it dictionary words cover, whether it is part of a path, and the words beside it. What it
confirms is merged where it overlaps.

It learns from labelled findings: a table of texts with a marked span and a label. :func:`labelled_findings` makes
one by putting known secrets and known harmless strings into pieces of ``SAMPLE`` texts of the corpus, at most, dealt by
a hash of the text. Which words beside a candidate speak for or against it is learned from the findings, too. Only the
findings come from a sample. Transitions are those of all byte pairs of the corpus. The dictionary is all words of four or
more letters (of any alphabet and length) outside candidates, of all documents; it stays a table, and those letter runs of
candidates that hold its words are found by a join (:func:`coverage`). Words of more than ``LOOKED_UP`` letters are looked
up by the first of these.

Null and empty texts have no candidates. An empty corpus gives no findings. Repeated texts are scanned alike. A text is
one value of a worker, which holds some ten times its bytes.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.forest import Forest, grow
from tablewright.llm.frames import deal, fresh_name, per_text, small_batches
from tablewright.llm.text import Chunk, chunks
from tablewright.operators.sizing import broadcast_if_small
from tablewright.session import stage

MIN_RUN = 16
THRESHOLD = 0.5
#: The bound of the sample of texts for labelled findings.
SAMPLE = 400
#: Characters of a sampled text, from a place that its hash tells.
PIECE = 2000
#: Letters by which words are looked up in candidates; longer words are compared whole then.
LOOKED_UP = 16
#: Findings in which a word must be beside a candidate to speak for or against it.
HEARD = 5
#: Words that a task holds, and rows that it hands over at once.
HELD = 100_000
FOUND = "array<struct<start:long,length:long,kind:string,score:double>>"
MARK = b"[REDACTED]"

_NAMES = (b"token", b"secret", b"passw", b"pwd", b"apikey", b"api_key", b"api-key", b"access_key", b"credential")
_ASSIGNED = re.compile(
    rb"(?i)(?:" + b"|".join(map(re.escape, _NAMES)) + rb")\w{0,24}[\"']?[ \t]{0,4}(?:=>|=|:)[ \t]{0,4}[\"']?"
    rb"([^\s\"',;]{6,})"
)
_BEGIN = re.compile(rb"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----")
_END = re.compile(rb"-----END [A-Z ]{0,40}PRIVATE KEY-----")
_LETTERS = re.compile(r"[^\W\d_]{4,}")
_WORD = re.compile(r"[^\W_]+")
_KIND = np.full(256, 4, np.int64)
_KIND[0x30:0x3A], _KIND[0x41:0x5B], _KIND[0x61:0x7B] = 0, 1, 2
_KIND[[0x2B, 0x2F, 0x2D, 0x5F]] = 3
_HEX = np.array([*range(0x30, 0x3A), *range(0x41, 0x47), *range(0x61, 0x67)])


def _blocks(raw: bytes) -> Iterator[tuple[int, int]]:
    """Key blocks: from a first line to the next last line."""
    reach, ends = 0, _END.finditer(raw)
    end = next(ends, None)
    for begin in _BEGIN.finditer(raw):
        if begin.start() < reach:
            continue
        while end is not None and end.start() < begin.end():
            end = next(ends, None)
        if end is None:
            return
        reach = end.end()
        yield begin.start(), reach


def _candidates(c: Chunk) -> Iterator[tuple[int, int, int, str]]:
    """Text number, start and end (bytes of the text), and kind; candidates may overlap."""
    kind = _KIND[c.data]
    solid = np.concatenate(([False], kind < 4, [False]))
    change = np.flatnonzero(solid[1:] != solid[:-1])
    begin, end = change[0::2], change[1::2]
    digits = np.concatenate(([0], np.cumsum(kind == 0)))
    runs = (end - begin >= MIN_RUN) & (digits[end] > digits[begin])
    begin, end = begin[runs], end[runs]
    owner = np.searchsorted(c.starts, begin, side="right") - 1
    spans: dict[int, list] = {}
    for t, b, e in zip(owner.tolist(), begin.tolist(), end.tolist(), strict=True):
        spans.setdefault(t, []).append((b - int(c.starts[t]), e - int(c.starts[t]), "run"))
    for t, raw in enumerate(c.texts):
        low = raw.lower()
        if any(name in low for name in _NAMES):
            spans.setdefault(t, []).extend((*m.span(1), "assigned") for m in _ASSIGNED.finditer(raw))
        if b"PRIVATE KEY-----" in raw:
            spans.setdefault(t, []).extend((b, e, "key_block") for b, e in _blocks(raw))
    for t, found in sorted(spans.items()):
        seen = set()
        for b, e, k in sorted(found, key=lambda s: (s[0], -s[1], s[2])):
            if (b, e) not in seen:
                seen.add((b, e))
                yield t, b, e, k


def merged(spans: list[tuple[int, int, str, float]]) -> list[tuple[int, int, str, float]]:
    """Spans without overlaps; a merged one has the kind of its longest part and the highest score."""
    found: list[list] = []
    for b, e, kind, score in sorted(spans):
        if found and b < found[-1][1]:
            last = found[-1]
            if e - b > last[4]:
                last[2], last[4] = kind, e - b
            last[1], last[3] = max(last[1], e), max(last[3], score)
        else:
            found.append([b, e, kind, score, e - b])
    return [tuple(f[:4]) for f in found]


def _text(raw: bytes) -> str:
    return raw.decode("utf-8", "replace").lower()


def _parts(raw: bytes, begin: int, end: int) -> list[str]:
    """The runs of four or more letters of a candidate."""
    return _LETTERS.findall(_text(raw[begin:end]))


def _pieces(part: str) -> Iterator[str]:
    """What of a run of letters could be a word, or the beginning of a long one."""
    for at in range(len(part) - 3):
        for size in range(4, min(LOOKED_UP, len(part) - at) + 1):
            yield part[at : at + size]


def covered(part: str, words: Iterable[str]) -> int:
    """How many letters of ``part`` are in words, the longest first, from the left."""
    by_head: dict[str, list[str]] = {}
    for word in sorted(words, key=len, reverse=True):
        by_head.setdefault(word[:4], []).append(word)
    done = at = 0
    while at < len(part) - 3:
        size = next((len(w) for w in by_head.get(part[at : at + 4], ()) if part.startswith(w, at)), 0)
        done += size
        at += size or 1
    return done


#: Words; byte pairs (``cell``) and their number; keys of texts with candidates, and the letter runs in these by place.
STATISTICS = "word string, cell int, key string, start long, end long, part string, n long"


def _frame(**columns: list) -> pd.DataFrame:
    size = len(next(iter(columns.values())))
    names = [c.split()[0] for c in STATISTICS.split(", ")]
    return pd.DataFrame({c: pd.Series(columns.get(c, [None] * size), dtype=object) for c in names})


def _gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Words outside candidates, letter runs of candidates by text and place, and sums of byte pairs of a task."""
    pairs, words = np.zeros(65536, np.int64), set()
    for batch in batches:
        texts, keys, runs = batch["text"].tolist(), batch["key"].tolist(), []
        for c in chunks(texts):
            data = c.data.astype(np.int64)
            pairs += np.bincount(data[:-1] * 256 + data[1:], minlength=65536)
            spans: dict[int, list] = {}
            for t, b, e, _ in _candidates(c):
                spans.setdefault(t, []).append((b, e))
            for t, raw in enumerate(c.texts):
                at, outside = 0, []
                if t in spans:
                    runs.append((keys[c.first + t], None, None, None, None))
                for b, e in spans.get(t, ()):
                    if b > at:
                        outside.append(raw[at:b])
                    at = max(at, e)
                    runs.extend((keys[c.first + t], b, e, p, n) for p, n in Counter(_parts(raw, b, e)).items())
                outside.append(raw[at:])
                words.update(_LETTERS.findall(_text(b" ".join(outside))))
            if len(words) > HELD:
                yield _frame(word=list(words))
                words = set()
        for i in range(0, len(runs), HELD):
            key, start, end, part, n = zip(*runs[i : i + HELD], strict=True)
            yield _frame(key=list(key), start=list(start), end=list(end), part=list(part), n=list(n))
    yield _frame(word=list(words))
    cells = np.flatnonzero(pairs)
    yield _frame(cell=cells.tolist(), n=pairs[cells].tolist())


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Words, letter runs of candidates and byte pairs of all documents, staged."""
    rows = docs.select(F.col(f"`{text}`").alias("text"), _key(F.col(f"`{text}`")).alias("key"))
    return stage(rows.mapInPandas(_gather, STATISTICS), "language")


def _key(text: Column) -> Column:
    """Equal texts have equal keys; null texts have keys of their own, so that they do not meet in one task."""
    return F.coalesce(F.sha2(text, 256), F.monotonically_increasing_id().cast("string"))


def transitions(found: DataFrame) -> np.ndarray:
    """Log frequencies of byte pairs by first byte: at most 65,536 sums come to the driver."""
    pairs = np.ones(65536)
    for r in found.where("cell is not null").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        pairs[r["cell"]] += r["n"]
    pairs = pairs.reshape(256, 256)
    return np.log(pairs / pairs.sum(axis=1, keepdims=True))


def coverage(found: DataFrame) -> DataFrame:
    """Per text with candidates (``key``) their places and how many of their letters are in dictionary words."""
    words = found.where("word is not null").select("word").distinct()
    words = words.select("word", F.substring("word", 1, LOOKED_UP).alias("head"))
    runs = found.where("part is not null").select("key", "start", "end", "part", "n").distinct()
    runs = runs.withColumn("id", F.md5("part"))

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = ((i, p) for batch in batches for i, part in zip(batch["id"], batch["part"], strict=True) for p in _pieces(part))
        while block := list(islice(rows, HELD)):
            yield pd.DataFrame(block, columns=["id", "head"])

    def count(parts: pd.Series, known: pd.Series) -> pd.Series:
        return pd.Series([covered(p, k) for p, k in zip(parts, known, strict=True)], dtype="int64")

    parts = runs.select("id", "part").distinct()
    known = parts.mapInPandas(pieces, "id string, head string").join(words, "head")
    known = known.groupBy("id").agg(F.collect_set("word").alias("words"))
    counted = parts.join(known, "id").select("id", F.pandas_udf(count, "long")("part", "words").alias("covered"))
    sums = runs.join(counted, "id").groupBy("key", "start", "end")
    sums = sums.agg(F.sum(F.col("n") * F.col("covered")).alias("covered"))
    spans = sums.groupBy("key").agg(F.collect_list(F.struct("start", "end", "covered")).alias("spans"))
    return found.where("key is not null").select("key").distinct().join(spans, "key", "left")


def beside(raw: bytes, begin: int) -> list[str]:
    """The words before a candidate, the nearest last."""
    return _WORD.findall(_text(raw[max(0, begin - 60) : begin]))[-5:]


def learned_words(findings: list[tuple[str, int, int, int]]) -> dict[str, float]:
    """How much a word beside a candidate speaks for a secret: log odds over the findings."""
    heard: dict[str, list[int]] = {}
    for text, begin, _, label in findings:
        for word in set(beside(text.encode(), begin)):
            heard.setdefault(word, [0, 0])[label] += 1
    total = Counter(label for *_, label in findings)
    weigh = lambda n: np.log((n[1] + 1) / (total[1] + 2)) - np.log((n[0] + 1) / (total[0] + 2))
    return {word: float(weigh(n)) for word, n in sorted(heard.items()) if sum(n) >= HEARD}


def features(
    raw: bytes, begin: int, end: int, pairs: np.ndarray, in_words: int, speaking: Mapping[str, float]
) -> list[float]:
    """What the forest sees of a candidate, of which ``in_words`` letters are in words."""
    body = np.frombuffer(raw[begin:end], np.uint8)
    kind, n = _KIND[body], max(1, len(body))
    counts = np.bincount(body, minlength=256)
    share = counts[counts > 0] / n
    low = max(0, begin - 200)
    token = raw[max(raw.rfind(b" ", low, begin), raw.rfind(b"\n", low, begin), low - 1) + 1 : begin]
    odds = [speaking[w] for w in beside(raw, begin) if w in speaking] or [0.0]
    before, after = raw[max(0, begin - 1) : begin], raw[end : end + 1]
    return [
        end - begin,
        *(np.bincount(kind, minlength=5)[:4] / n),
        float((kind[1:] != kind[:-1]).sum()) / n,
        float(-(share * np.log2(share)).sum()),
        float(pairs[body[:-1], body[1:]].mean()) if n > 1 else 0.0,
        in_words / n,
        float(b"/" in token or b"." in token or counts[0x2F] > 0),
        float(counts[0x2D] + counts[0x5F]) / n,
        float(counts[_HEX].sum() == len(body)),
        sum(odds),
        max(odds),
        min(odds),
        float(bool(re.search(rb"[=:][ \t]*[\"']?$", raw[max(0, begin - 8) : begin]))),
        float(before in (b'"', b"'") and after == before),
        float(body[:5].tobytes() == b"-----"),
    ]


def labelled_findings(texts: list[str], seed: int = 5) -> list[tuple[str, int, int, int]]:
    """Texts of the corpus with one known string each: text, start, end (bytes) and 1 for a secret."""
    random = np.random.RandomState(seed)
    pick = lambda letters, n: "".join(letters[i] for i in random.randint(0, len(letters), n))
    hexes, digits = "0123456789abcdef", "0123456789"
    mixed = digits + "abcdefghijklmnopqrstuvwxyz" + "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    names = ("token", "secret", "api_key", "password", "access_token", "client_secret", "auth_token", "pwd", "apikey")
    names += ("credential", "access_key", "private_key_password", "db_passwd")
    lines = lambda letters: "\n".join(pick(letters, 64) for _ in range(random.randint(4, 26)))
    frame = lambda body, kind: f"-----BEGIN {kind}PRIVATE KEY-----\n{body}\n-----END {kind}PRIVATE KEY-----"
    kinds_of_key = ("", "RSA ", "EC ", "OPENSSH ")
    word = lambda words: words[random.randint(len(words))].strip(".,\"'") or "a"
    found = []
    for text in texts:
        words = text.split() or ["a"]
        name = names[random.randint(len(names))]
        secrets = (
            (f'{name} = "', pick(hexes, random.choice([32, 40, 64])), '"'),
            (f"{name}: ", pick(mixed, random.randint(16, 64)), ""),
            (f'{name}="', pick(mixed + "+/", 40), '"'),
            ("", "AKIA" + pick(digits + "ABCDEFGHIJKLMNOPQRSTUVWXYZ", 16), ""),
            ("", "ghp_" + pick(mixed, 36), ""),
            ("Authorization: Bearer ", pick(mixed + "-_", random.randint(30, 90)), ""),
            (f"{name} = ", pick(mixed + "!$%&", random.randint(10, 20)), ""),
            ("", frame(lines(mixed + "+/"), kinds_of_key[random.randint(4)]), ""),
        )
        harmless = (
            ("", pick(digits, 16), ""),
            ("phone ", pick(digits, 4) + "-" + pick(digits, 6) + "-" + pick(digits, 6), ""),
            ("https://www.example.com/", "/".join(word(words) for _ in range(4)) + "/" + pick(digits, 4), ""),
            ("commit ", pick(hexes, 40), ""),
            ("sha256 ", pick(hexes, 64), ""),
            ("uuid ", "-".join(pick(hexes, n) for n in (8, 4, 4, 4, 12)), ""),
            ("", "-".join(word(words) for _ in range(4)) + "-" + pick(digits, 2), ""),
            ("", "_".join(word(words) for _ in range(4)) + pick(digits, 1), ""),
            ("", "2024-0" + pick(digits[1:], 1) + "-11T10-22-33-" + pick(digits, 4), ""),
            ("", pick(digits[:2], 1) * 20, ""),
            (f"{name}: ", word(words) + word(words) + word(words) + "s", ""),
            (f"the {name} = ", "your_" + name + "_here_" + pick(digits, 1), ""),
            ("", frame(" ".join(word(words) for _ in range(random.randint(1, 30))), kinds_of_key[random.randint(4)]), ""),
            (f"{name}_url = ", "https://host/" + "/".join(word(words) for _ in range(3)), ""),
        )
        for kinds, label in ((secrets, 1), (harmless, 0)):
            for k in random.permutation(len(kinds))[:3]:
                before, body, after = kinds[k]
                at = random.randint(0, len(words) + 1)
                head = " ".join([*words[max(0, at - 8) : at], before]).encode()
                core = body.encode()
                tail = (after + " " + " ".join(words[at : at + 8])).encode()
                found.append(((head + core + tail).decode(), len(head), len(head) + len(core), label))
    return found


@dataclass(frozen=True)
class Scanner:
    forest: Forest
    pairs: np.ndarray
    speaking: dict[str, float]

    def scores(self, found: list[tuple[bytes, int, int, int]]) -> np.ndarray:
        """Scores of candidates: text, start, end, and how many letters are in words."""
        rows = [features(raw, b, e, self.pairs, n, self.speaking) for raw, b, e, n in found]
        return self.forest.predict(np.array(rows)) if rows else np.zeros(0)

    def scan(self, c: Chunk, known: list[dict[tuple[int, int], int]]) -> dict[int, list[tuple[int, int, str, float]]]:
        """Per text the spans (bytes) that the forest confirms, merged; ``known``: letters in words, by place."""
        spans = list(_candidates(c))
        scores = self.scores([(c.texts[t], b, e, known[c.first + t].get((b, e), 0)) for t, b, e, _ in spans])
        found: dict[int, list] = {}
        for (t, b, e, kind), score in zip(spans, scores.tolist(), strict=True):
            if score >= THRESHOLD:
                found.setdefault(t, []).append((b, e, kind, score))
        return {t: merged(confirmed) for t, confirmed in found.items()}


def letters_in_words(found: DataFrame, findings: list[tuple[str, int, int, int]]) -> list[int]:
    """Per finding how many of its letters are in dictionary words; the findings are few, and so are their pieces."""
    parts = [_parts(t.encode(), b, e) for t, b, e, _ in findings]
    pieces = pd.DataFrame({"head": sorted({w for ps in parts for p in ps for w in _pieces(p)})}, dtype=object)
    asked = F.broadcast(found.sparkSession.createDataFrame(pieces, "head string"))
    words = found.where("word is not null").select("word", F.substring("word", 1, LOOKED_UP).alias("head"))
    longest = max((len(p) for ps in parts for p in ps), default=0)
    words = words.where(F.length("word") <= longest).join(asked, "head", "left_semi")
    held: dict[str, list[str]] = {}
    for r in words.select("word").distinct().collect():  # no more than begin with a piece
        held.setdefault(r["word"][:4], []).append(r["word"])
    near = lambda p: {w for at in range(len(p) - 3) for w in held.get(p[at : at + 4], ())}
    return [sum(covered(p, near(p)) for p in ps) for ps in parts]


def train(found: DataFrame, texts: list[str], findings: list[tuple[str, int, int, int]] | None = None) -> Scanner | None:
    """A scanner from the statistics of all documents and labelled findings, made of sample texts if not given."""
    if not texts and not findings:
        return None
    pairs = transitions(found)
    findings = labelled_findings(texts) if findings is None else findings
    speaking = learned_words(findings)
    rows = zip(findings, letters_in_words(found, findings), strict=True)
    x = np.array([features(t.encode(), b, e, pairs, n, speaking) for (t, b, e, _), n in rows])
    return Scanner(grow(x, np.array([f[3] for f in findings])), pairs, speaking)


def sample(docs: DataFrame, text: str = "text", bound: int = SAMPLE) -> list[str]:
    """Pieces of at most ``bound`` texts, the same for the same corpus."""
    rows = docs.select(F.col(f"`{text}`").alias("text"), F.lit(1).alias("label")).where(F.length("text") > 0)
    picked = deal(rows, "label", "text", bound)[0]
    begin = F.pmod(F.xxhash64("text"), F.greatest(F.lit(1), F.length("text") - PIECE)).cast("int") + 1
    return sorted(r["piece"] for r in picked.select(F.substring("text", begin, F.lit(PIECE)).alias("piece")).collect())


def _on_texts(scanner: Scanner | None, texts: list, known: list) -> Iterator[tuple[int, bytes, list]]:
    if scanner is not None:
        places = [{(s["start"], s["end"]): s["covered"] for s in ([] if k is None else k)} for k in known]
        for c in chunks(texts):
            for t, spans in scanner.scan(c, places).items():
                yield c.first + t, c.texts[t], spans


def with_coverage(docs: DataFrame, found: DataFrame, text: str, how: str) -> tuple[DataFrame, list[Column]]:
    """``docs`` and what is known of their candidates (inner: those that have any); the columns that a scan takes.

    Few texts have candidates: what is known of them is broadcast if it has been measured to be small.
    """
    key, of, spans = (fresh_name(docs, name) for name in ("_text_key", "_key", "_spans"))
    known = stage(coverage(found).select(F.col("key").alias(of), F.col("spans").alias(spans)), "candidates")
    rows = docs.withColumn(key, _key(F.col(f"`{text}`"))).join(broadcast_if_small(known), F.col(key) == F.col(of), how)
    has = F.when(F.col(of).isNotNull(), F.col(f"`{text}`"))  # others do not go to a Python worker
    return rows, [has, F.col(spans)]


def finder(scanner: Scanner | None) -> Callable[..., Column]:
    """A function of the text: its secrets, positions in characters; null if there are none."""

    def find(texts: pd.Series, known: pd.Series) -> pd.Series:
        results: list = [None] * len(texts)
        for i, raw, spans in _on_texts(scanner, texts.tolist(), known.tolist()):
            results[i] = [
                {
                    "start": len(raw[:b].decode("utf-8", "replace")),
                    "length": len(raw[b:e].decode("utf-8", "replace")),
                    "kind": kind,
                    "score": score,
                }
                for b, e, kind, score in spans
            ]
        return pd.Series(results, dtype=object)

    return per_text(find, FOUND)


def redactor(scanner: Scanner | None) -> Callable[..., Column]:
    """A function of the text: the text with a mark in the place of every secret; null if there are none."""

    def redact(texts: pd.Series, known: pd.Series) -> pd.Series:
        results: list = [None] * len(texts)
        for i, raw, spans in _on_texts(scanner, texts.tolist(), known.tolist()):
            kept, at = [], 0
            for b, e, _, _ in spans:
                kept += [raw[at:b], MARK]
                at = e
            results[i] = b"".join([*kept, raw[at:]]).decode("utf-8", "replace")
        return pd.Series(results, dtype=object)

    return per_text(redact, "string")


def findings(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per secret: id, start and length in characters, kind and score."""
    small_batches(docs.sparkSession)
    known = statistics(docs, text)
    scanner = train(known, sample(docs, text))
    marked, scanned = with_coverage(docs, known, text, "inner")
    marked = marked.select(id_column, finder(scanner)(*scanned).alias("_found"))
    rows = marked.where(F.col("_found").isNotNull()).select(id_column, F.explode("_found").alias("f"))
    return rows.select(id_column, "f.*")


def redacted(docs: DataFrame, text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """``docs`` with secrets replaced by a mark, and their number of characters brought up to date."""
    small_batches(docs.sparkSession)
    known = statistics(docs, text)
    scanner = train(known, sample(docs, text))
    name = fresh_name(docs, "_clean")
    rows, scanned = with_coverage(docs, known, text, "left")
    done = rows.withColumn(name, redactor(scanner)(*scanned))
    done = done.withColumn(name, F.coalesce(F.col(name), F.col(f"`{text}`")))
    columns = {text: F.col(name)}
    if n_chars in docs.columns:
        columns[n_chars] = F.length(name).cast(docs.schema[n_chars].dataType)
    return done.select(*[columns.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])
