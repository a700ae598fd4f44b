"""Personal data: spans by pattern, and further ones by a character-level BiLSTM with CRF transitions.

The patterns find e-mail addresses, IP addresses, card and phone numbers in their plain forms. The tagger is trained on
labelled spans, the plain ones of a bounded sample of rows and written variants of them (``name (at) host dot com``,
phones without the country sign), and adds such variants where they occur. Overlapping windows cover every text from end
to end. A tagged span counts only if it has the written form of its kind (``checked``), so windows in which no such form
can lie are not decoded: nothing could come of them.
"""

from __future__ import annotations

import bisect
import random
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.llm import common
from postlake.llm.tagger import Tagger, codes

KINDS = ("email", "ip", "card", "phone")
#: Characters of a window, and from one window to the next.
WINDOW, STRIDE = 96, 32
#: Characters around a trigger, and the words which belong to it, that windows of the training sample cover.
AROUND = 40
#: Windows with labelled spans that the tagger is trained on at most (the least by a hash of the row and the place).
TRAIN_WINDOWS = 1200
#: Variants of each of them that has an address or a phone.
VARIANTS = 2
#: Windows decoded at once.
DECODE = 512
#: A span that the tagger adds must be ahead of "no span" by this much for each character.
LEAD = 2.0

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A start inside a run of digits finds nothing that the start of the run does not, so runs are tried once.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_AT_WORD = r"[(\[{] ?at ?[)\]}]| at (?=[A-Za-z0-9-]{1,63} (?:dot|\(dot\)|\[dot\]) )"
_TRIGGER = re.compile(r"[0-9@]+|" + _AT_WORD)
_WRITTEN_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+(?: ?[(\[{] ?at ?[)\]}] ?| at )[A-Za-z0-9-]+(?:(?:\.| ?[(\[{] ?dot ?[)\]}] ?| dot )[A-Za-z0-9-]+)+")
#: What every written address has behind its local part: the at word, and the domain's first word and dot.
_AT_DOMAIN = re.compile(
    r"(?<=[A-Za-z0-9._%+-])(?: ?[(\[{] ?at ?[)\]}] ?| at )(?=[A-Za-z0-9-]++(?:\.| ?[(\[{] ?dot ?[)\]}] ?| dot )[A-Za-z0-9-])"
)
_DIGIT = re.compile("[0-9]")
_DOMAIN_WORDS = re.compile(r"(?: ?[A-Za-z0-9-]++(?:(?:\.| ?[(\[{] ?dot ?[)\]}] ?| dot )[A-Za-z0-9-]++)*+)?+")
_WRITTEN_PHONE = re.compile(r"(?:\([0-9]{2,4}\)|[0-9]{2,4})(?:[ .-][0-9]{2,4}){2,4}")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, at sign, domain. The local part can only be the run before the sign, so each sign is tried once."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            yield start, done
        else:
            done = at + 1
        at = text.find("@", done)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the plain forms, leftmost and without overlap within a kind; failing matches are dropped."""
    found = [(a, 0, b) for a, b in emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def regions(text: str) -> list[tuple[int, int]]:
    """What windows cover: all of the text."""
    return [(0, len(text))] if text else []


def windows(text: str, over: list[tuple[int, int]] | None = None) -> Iterator[tuple[int, int, int, int]]:
    """Overlapping windows over every region (by default all of the text): start, end, and the region they are of."""
    for a, b in regions(text) if over is None else over:
        at = a
        while True:
            yield at, min(at + WINDOW, b), a, b
            if at + WINDOW >= b:
                break
            at += STRIDE


def may_have_form(text: str) -> Callable[[int, int], bool]:
    """Tells of a window whether ``checked`` can accept any span in it. Where it says no, decoding gives nothing.

    ``checked`` looks for a written form in the span and two characters on either side. A written address has an at word
    with a domain behind it, a written phone has nine digits, and what the part has the window has too.
    """
    ats = [(m.start(), m.end()) for m in _AT_DOMAIN.finditer(text)]
    ends = [b for _, b in ats]
    digits = [m.start() for m in _DIGIT.finditer(text)]

    def told(start: int, end: int) -> bool:
        low, high = max(0, start - 2), end + 2
        i = bisect.bisect_right(ends, low)
        if i < len(ats) and ats[i][0] < high:
            return True
        return bisect.bisect_left(digits, high) - bisect.bisect_left(digits, low) >= 9

    return told


def near_triggers(text: str) -> list[tuple[int, int]]:
    """The surroundings of all digits, at signs and at words, joined where they meet, from which the training sample is taken.

    They reach ``AROUND`` beyond the run of a local part before a trigger and the domain words after it, however long
    these are.
    """
    out: list[list[int]] = []
    reach = 0
    for m in _TRIGGER.finditer(text):
        a, done = m.start(), out[-1][1] if out else 0
        if a and text[a - 1] == " ":
            a -= 1
        while a > done and text[a - 1] in _LOCAL:
            a -= 1
        if m.end() > reach:
            reach = _DOMAIN_WORDS.match(text, m.end()).end()
        a, b = max(0, a - AROUND), min(len(text), max(reach, m.end()) + AROUND)
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def labels_of(spans: list[tuple[int, int, int]], start: int, end: int) -> np.ndarray:
    """0 outside, then for each kind its first and its further characters."""
    out = np.zeros(end - start, dtype=np.int64)
    for a, kind, b in spans:
        for i in range(max(a, start), min(b, end)):
            out[i - start] = 1 + 2 * kind + (i > a)
    return out


def variants(text: str, spans: list[tuple[int, int, int]], rng: random.Random) -> tuple[str, list[tuple[int, int, int]]]:
    """The text with its e-mail addresses and phones written another way, and the spans moved along."""
    out, new, done = [], [], 0
    size = 0
    for a, kind, b in spans:
        if a < done:
            continue
        piece = text[a:b]
        if kind == 0:
            at, dot = rng.choice([(" (at) ", " (dot) "), ("[at]", "[dot]"), (" at ", " dot "), ("(at)", "."), (" [at] ", " [dot] "), ("{at}", ".")])
            local, _, domain = piece.rpartition("@")
            piece = local + at + domain.replace(".", dot)
        elif kind == 3:
            digits = re.sub("[^0-9]", "", piece)[-10:]
            parts = digits[:3], digits[3:6], digits[6:]
            piece = rng.choice(["({}) {}-{}", "{}-{}-{}", "{}.{}.{}", "({}) {} {}", "{} {} {}"]).format(*parts)
        out += [text[done:a], piece]
        size += a - done
        new.append((size, kind, size + len(piece)))
        size += len(piece)
        done = b
    return "".join([*out, text[done:]]), new


def sample(docs: DataFrame, key: str, text: str, most: int = TRAIN_WINDOWS) -> list[tuple[str, list]]:
    """At most ``most`` windows of text with triggers and their plain spans: half with spans, half without."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            out = []
            for name, data in zip(batch.column(0).to_pylist(), common.as_texts(batch.column(1))):
                spans = base_spans(data)
                starts = [s[0] for s in spans]
                for start, end, _, _ in windows(data, near_triggers(data)):
                    near = spans[max(0, bisect.bisect_left(starts, start) - 4) : bisect.bisect_left(starts, end)]
                    cut = any(a < start < b or a < end < b for a, _, b in near)
                    own = [(a - start, k, b - start) for a, k, b in near if a >= start and b <= end]
                    if not cut:
                        out.append((bool(own), xxhash.xxh64_intdigest(f"{name} {start} {data[start:end]}") >> 1, data[start:end], str(own)))
            kinds = [pa.bool_(), pa.int64(), pa.string(), pa.string()]
            columns = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["some", "h", "text", "spans"])

    rows = docs.select(docs[key].alias("k"), docs[text].alias("t")).filter(F.col("t").rlike("[0-9@]"))
    rows = common.written(common.map_in_arrow(rows, run, "some boolean, h bigint, text string, spans string"), "windows")
    picked = []
    for some in (True, False):
        picked += rows.filter(F.col("some") == some).orderBy("h", "text").limit(most // 2).collect()
    return [(r["text"], [tuple(map(int, x)) for x in re.findall(r"\((\d+), (\d+), (\d+)\)", r["spans"])]) for r in picked]


def examples(picked: list[tuple[str, list]], seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Codes and labels of the sample: each window as it is, and those with addresses or phones as variants too."""
    rng = random.Random(seed)
    rows = []
    for text, spans in picked:
        rows.append((text, spans))
        if any(k in (0, 3) for _, k, _ in spans):
            rows += [variants(text, spans, rng) for _ in range(VARIANTS)]
    x, y = np.zeros((len(rows), WINDOW), dtype=np.int64), np.zeros((len(rows), WINDOW), dtype=np.int64)
    for i, (text, spans) in enumerate(rows):
        text = text[:WINDOW]
        x[i, : len(text)] = codes(text)
        y[i, : len(text)] = labels_of(spans, 0, len(text))
    return x, y


def fitted(docs: DataFrame, key: str = "doc_id", text: str = "text", most: int = TRAIN_WINDOWS, epochs: int = 10) -> Tagger:
    """A tagger trained on a bounded sample. Without any example it is left untrained and finds nothing."""
    x, y = examples(sample(docs, key, text, most))
    tagger = Tagger.new(1 + 2 * len(KINDS), hidden=16)
    if len(x) and y.any():
        tagger.train(x, y, epochs)
    else:
        tagger.weights["O"][:], tagger.weights["o"][0] = 0, 100.0
    return tagger


def path_spans(path: list[int], lead: np.ndarray) -> Iterator[tuple[int, int, int, float]]:
    """(start, kind, end, mean lead) of the runs of one kind in a label path."""
    at = 0
    while at < len(path):
        if path[at] == 0:
            at += 1
            continue
        kind, end = (path[at] - 1) // 2, at + 1
        while end < len(path) and path[end] == 2 + 2 * kind:
            end += 1
        yield at, kind, end, float(lead[at:end].mean())
        at = end


def checked(text: str, start: int, kind: int, end: int) -> tuple[int, int] | None:
    """The part of a tagged span that has the form of its kind, if any."""
    piece = text[max(0, start - 2) : end + 2]
    if kind == 0:
        m = _WRITTEN_EMAIL.search(piece)
    elif kind == 3:
        m = _WRITTEN_PHONE.search(piece)
        if m and not 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            m = None
    else:
        m = None  # plain addresses and card numbers have no other form; what fails their rules is none
    if not m or m.end() - m.start() < 0.6 * (end - start):
        return None
    a, b = max(0, start - 2) + m.start(), max(0, start - 2) + m.end()
    if (a and text[a - 1].isalnum()) or (b < len(text) and text[b].isalnum()):
        return None
    return a, b


def reconciled(found: list[tuple[int, int, int, float]], fixed: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The set of spans without overlap, among themselves and with the fixed ones, that has the largest sum of scores over the whole text."""
    scores: dict[tuple[int, int, int], float] = {}
    for a, k, b, score in found:
        scores[a, k, b] = max(score, scores.get((a, k, b), 0.0))
    free, reach = [], 0
    taken = sorted((a, b) for a, _, b in fixed)
    starts = [a for a, _ in taken]
    tops = []
    for _, b in taken:
        reach = max(reach, b)
        tops.append(reach)
    for (a, k, b), score in scores.items():
        before = bisect.bisect_left(starts, b)
        if not before or tops[before - 1] <= a:
            free.append((b, a, k, score * (b - a)))
    free.sort()
    ends, best, choice = [x[0] for x in free], [0.0], []
    for i, (b, a, k, score) in enumerate(free):
        j = bisect.bisect_right(ends, a, 0, i)
        take = best[j] + score
        choice.append(j if take > best[-1] else -1)
        best.append(max(take, best[-1]))
    out, i = [], len(free)
    while i:
        if choice[i - 1] < 0:
            i -= 1
        else:
            out.append((free[i - 1][1], free[i - 1][2], free[i - 1][0]))
            i = choice[i - 1]
    return out[::-1]


def tagged(texts: list[str], fixed: list[list[tuple[int, int, int]]], tagger: Tagger) -> list[list[tuple[int, int, int]]]:
    """Further spans of each text: the same as of all windows decoded, some hundreds at a time, then reconciled for the whole text."""
    found: list[list[tuple[int, int, int, float]]] = [[] for _ in texts]
    pending: list[tuple[int, int, int, int, int]] = []

    def flush() -> None:
        x = np.zeros((len(pending), WINDOW), dtype=np.int64)
        for i, (n, a, b, _, _) in enumerate(pending):
            x[i, : b - a] = codes(texts[n][a:b])
        paths, leads = tagger.decode(x)
        for (n, a, b, low, high), path, lead in zip(pending, paths, leads):
            if not path.any():
                continue
            for start, kind, end, score in path_spans(path[: b - a].tolist(), lead):
                # Cut off by the window's edge: the next window has it whole.
                if (start == 0 and a > low) or (end == b - a and b < high):
                    continue
                if score >= LEAD and (part := checked(texts[n], a + start, kind, a + end)):
                    found[n].append((part[0], kind, part[1], score))
        pending.clear()

    for n, text in enumerate(texts):
        possible = may_have_form(text)
        for window in windows(text):
            if possible(window[0], window[1]):
                pending.append((n, *window))
            if len(pending) == DECODE:
                flush()
    if pending:
        flush()
    return [reconciled(own, base) if own else [] for own, base in zip(found, fixed)]


RESULT = "struct<base:array<struct<kind:string,start:bigint,end:bigint>>,added:array<struct<kind:string,start:bigint,end:bigint>>>"


def spans(text: Column | str, tagger: Tagger) -> Column:
    """``base`` and ``added`` spans of each whole text, in code points, by start and then kind.

    Base spans follow the patterns and always stay. Added ones never overlap them or each other. Null and empty texts
    have none. Rows are worked alone, so ties, repeated rows and other columns play no part.
    """

    def run(texts: pa.Array) -> pa.Array:
        rows = list(common.as_texts(texts))
        base = [base_spans(x) for x in rows]
        more = tagged(rows, base, tagger)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        both = [[[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in own] for own in part] for part in (base, more)]
        return pa.StructArray.from_arrays([pa.array(x, kind) for x in both], ["base", "added"])

    return common.struct_column(common.arrow_udf(run, RESULT), text)


def joined(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def query(spark: SparkSession, folder: str) -> DataFrame:
    docs = common.table(spark, folder, "documents")
    return digest(docs, fitted(docs))


def digest(docs: DataFrame, tagger: Tagger) -> DataFrame:
    found = docs.select("doc_id", spans(docs["text"], tagger).alias("s")).select("doc_id", "s.base", "s.added")
    order = F.array(*map(F.lit, KINDS))
    ranked = F.transform(F.concat("base", "added"), lambda s: F.struct(s["start"].alias("start"), F.array_position(order, s["kind"]).alias("rank"), s["kind"].alias("kind"), s["end"].alias("end")))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, KINDS), F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.array_sort(ranked)).alias("spans"))
