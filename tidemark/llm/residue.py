"""Template residue, filler, error pages and script notices in texts, by character n-gram models.

Natural prose is counted over all texts of the corpus, the other classes over a bounded labelled sample (see
residue_samples). A model is the frequency of hashed n-grams of lower-case text, digits as 0. Texts are cut into
windows, their lines and sentences (long ones into pieces); each window gets the log likelihood ratio of each class
against prose, and the class of the greatest one above a margin. Filler that is only a part of a sentence is the run of
n-grams with the greatest sum of log ratios, less a cost for each, unless it is quoted or spoken of. The text is then
judged by coverage: filler by its length or, where it is short, its share, notices by their share of all that isn't
menu. Placeholders are found by the markers that surround a name, and each counts unless there is evidence that it is
spoken of or is content: a run of n-grams around it that a further pair of models, of what is said about placeholders
and of texts that use them, finds likely to be about it, or, for brackets that natural texts have too, a name that is
a control string, a cell or a single letter, or code that the bracket is part of. Frequencies, not counts, are
smoothed: an n-gram neither model knows says nothing, and results don't drift with the size of the corpus.

All windows of some texts are scored at once, as sums over one array of n-grams; Python sees a window on its own only
where a run of filler is likely in it, and a line only where it holds a marker.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.residue_samples import samples

#: Length of n-grams, buckets they are hashed into, smoothing of frequencies.
N, BUCKETS, SMOOTHING = 5, 2**18, 2e-6
#: Longest window, mean and whole log ratio a window needs, log ratio a run of n-grams about a placeholder needs, characters of filler in a longer text and share of filler or notices that make a case.
WINDOW, MARGIN, LEAST, EVIDENCE, FILLER_CHARS, NOTICE_SHARE = 160, 0.5, 7.0, 20.0, 9, 0.5
#: What an n-gram costs a run that neither model knows, so that chance matches far from each other don't add up.
UNKNOWN = 4.0
#: What an n-gram costs a run of filler or mention, and the sums that runs need.
COST, FILLER_RUN, MENTION_RUN = 2.0, 15.0, 25.0

#: Classes that a window is held against prose for. The last two are natural: prose that shares the words of the others,
#: and what people write of other things than the corpus does.
CLASSES = ("filler", "notice", "chrome", "mention", "everyday")
NATURAL = CLASSES.index("mention")
PROSE = len(CLASSES)
#: Control strings and tags that are no placeholders. Fixed values.
CONTROLS = "unk|s|pad|bos|eos|mask|sep|cls"
TAGS = CONTROLS + "|startoftext|endoftext|noscript|script|hr|br|h\\d|p|b|i|em|strong|div|span|td|tr|th|li|ul|ol|a|html|body|head|title"

#: Characters that are scored together; a longer text is cut at a blank into parts that are.
TOGETHER = 100_000

NAME = r"[\p{L}][\p{L}\p{M}\p{N} ._\-]{0,40}"
WORD = r"[\p{L}][\p{L}\p{M}\p{N}_.\-]{1,40}"
#: Opening and closing markers around a name. Fixed values.
MARKERS = [(r"%\(", r"\)s"), (r"<<\s*", r"\s*>>"), (r"@@", r"@@"), (r"\[", r"\]"), (r"\{", r"\}"), (rf"<(?!(?i:{TAGS})>|(?i:{CONTROLS})\b)", r">")]
#: Markers that only templates have: anything but blanks may stand between them, as long as no other one opens.
CLEAR = [(r"\{\{", r"\}\}"), (r"[$#]\{", r"\}"), (r"<%", r"%>"), (r"\{%", r"%\}"), (r"\*\|", r"\|\*")]
#: The same around a single word, and double brackets around a name that may have parts.
TIGHT = [(r"\$", r"\$"), (r"__", r"__"), (r"%", r"%")]
PARTED = r"\[\[\s*[\p{L}][\p{L}\p{M}\p{N} ._\-/'|:]{0,60}\]\]"
PLACEHOLDER = regex.compile("|".join([rf"{o}\s*+(?!{c})(?:(?!{o}|{c}).)++{c}" for o, c in CLEAR] + [PARTED] + [o + NAME + c for o, c in MARKERS] + [o + WORD + c for o, c in TIGHT] + [r"\{\d{1,3}\}", r"(?<![\p{L}\p{N}:/@.])::?[a-z][a-z0-9]*(?:_[a-z0-9]+)+\b"]))
#: A character that every placeholder has.
MARKED = re.compile(r"[\[{<%$@_*:]")
#: Names and single characters that brackets hold in natural texts, and code that a bracket is part of. Fixed values.
CONTENT = regex.compile(r"(?:\[(?:\p{L}|[A-Z]{1,2}\d+)\]|\{(?:\p{L}|[A-Z]{1,2}\d+)\}|<\p{L}>|(?:\[|<|<<|\[\[|__)(?i:sic|mask|sep|cls|pad|unk|bos|eos|inst|sys|info|warn|warning|error|debug|trace|fatal|init|main|name|file)(?:\]|>|>>|\]\]|__))")
IN_CODE = regex.compile(r"[\w)\]]$")
#: What a text quotes, cut out before filler is looked for within a sentence.
QUOTED = regex.compile(r"(?<!\w)(?:'[^']{1,300}'|\"[^\"]{1,300}\"|«[^»]{1,300}»|“[^”]{1,300}”|„[^“”]{1,300}[“”]|‘[^’]{1,300}’)(?!\w)")
#: A record's opening in transcripts and lists: speaker, time, bullet.
OPENING = regex.compile(r"^(?:(?:agent|customer|C|Q|A)\s?[>:]|\[\d\d:\d\d\]|[>*\-#]+|\d+\.)\s*")

#: AFTER: a capital right behind a placeholder opens a sentence too.
DIGIT, BLANKS, SENTENCE, LINE, AFTER = (regex.compile(p) for p in (r"\d", r"\s+", r"(?<=[.!?])\s+", r"[\r\n]+", r"(?<=[.!?])\s+|^\s+(?=\p{Lu}\p{Ll})"))


def prepared(text: str) -> str:
    return BLANKS.sub(" ", DIGIT.sub("0", text.lower()))


def hashed(codes: np.ndarray) -> np.ndarray:
    """Buckets of the n-grams of an array of code points (uint32)."""
    if len(codes) < N:
        return np.zeros(0, np.int32)
    h = np.zeros(len(codes) - N + 1, np.uint32)
    for i in range(N):
        h *= np.uint32(0x01000193)
        h ^= codes[i : len(codes) - N + 1 + i]
        h ^= h >> np.uint32(15)
    h *= np.uint32(0x9E3779B1)
    return (h >> np.uint32(32 - BUCKETS.bit_length() + 1)).astype(np.int32)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def grams(text: str) -> np.ndarray:
    """Buckets of the n-grams of a prepared text with its borders marked."""
    return hashed(_codes(f"\x01\x01{text}\x01\x01"))


def counted(texts: list[str], borders: bool = True) -> np.ndarray:
    """n-gram counts of texts; of phrases, which stand anywhere in a sentence, without those of the borders."""
    out = np.zeros(BUCKETS, np.int64)
    for t in map(prepared, texts):
        np.add.at(out, grams(t) if borders else grams(t)[2:-2], 1)
    return out


@dataclass
class Windows:
    """Windows of some texts: their n-grams in one array, and of each window its text's number and its n-grams' range."""

    codes: np.ndarray
    buckets: np.ndarray
    of: np.ndarray
    begin: np.ndarray
    end: np.ndarray

    def text(self, k: int) -> str:
        return self.codes[self.begin[k] : self.end[k] + N - 1].tobytes().decode("utf-32-le", "surrogatepass").strip("\x01")

    def lengths(self) -> np.ndarray:
        return self.end - self.begin

    def covered(self) -> np.ndarray:
        """Whether an n-gram belongs to a window, and not to the border of two."""
        steps = np.zeros(len(self.buckets) + 1, np.int8)
        np.add.at(steps, self.begin, 1)
        np.add.at(steps, self.end, -1)
        return np.cumsum(steps[:-1], dtype=np.int8) > 0

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Sums of the values of each n-gram, a row an n-gram, by window."""
        if not len(self.of):
            return np.zeros((0, values.shape[1]))
        return np.add.reduceat(values, np.stack([self.begin, self.end], axis=1).ravel(), axis=0)[::2]


#: Code points that are blank, and those that end a sentence before a blank. Fixed values.
BLANK_CODES = np.array([*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000], np.uint32)
ENDS = np.array([ord(c) for c in ".!?"], np.uint32)
#: What stands between two windows: the end of one (twice 1), a border, the begin of the next.
BETWEEN = np.array([1, 1, 0, 1, 1], np.uint32)


def windows(texts: list[str]) -> Windows:
    """Lines and sentences of texts, those beyond WINDOW in pieces: lower-case, digits as 0, runs of blanks as one."""
    plain = lambda t: t.translate({0: " ", 1: " ", 2: " "}) if "\x00" in t or "\x01" in t or "\x02" in t else t
    codes = _codes("\n\x02\n" + "\n\x02\n".join(map(plain, texts)).lower() + "\n\x02\n").copy()
    codes[(codes >= 48) & (codes <= 57)] = 48
    blank = (codes == 32) | (codes == 10) | (codes == 2)
    rare = np.flatnonzero((codes < 32) | (codes > 126))
    blank[rare] |= np.isin(codes[rare], BLANK_CODES)
    # Runs of blanks: those with a line break, or behind the end of a sentence, part windows; in those with a 2 a text ends.
    edge = np.diff(blank.astype(np.int8), prepend=0, append=0)
    start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    within = lambda hit: (lambda c: c[stop] > c[start])(np.concatenate([[0], np.cumsum(hit)]))
    ends_text = within(codes == 2)
    parts = within((codes == 10) | (codes == 13)) | np.isin(codes[np.maximum(start - 1, 0)], ENDS)
    width = (~blank).astype(np.int64)
    width[start] = np.where(parts, len(BETWEEN), 1)
    at = np.cumsum(width) - width
    out = np.repeat(codes, width)
    out[at[start[~parts]]] = 32
    border = at[start[parts]]
    out[border[:, None] + np.arange(len(BETWEEN))] = BETWEEN
    begin, end = border[:-1] + 3, border[1:] + 2 - (N - 1)
    of = np.cumsum(ends_text[parts])[:-1] - 1
    full = end > begin
    begin, end, of = begin[full], end[full], of[full]
    pieces = np.maximum(1, -(-(end - begin) // WINDOW))
    first = np.repeat(begin, pieces) + WINDOW * (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces))
    return Windows(out, hashed(out), np.repeat(of, pieces), first, np.minimum(first + WINDOW, np.repeat(end, pieces)))


def cut_up(text: str) -> list[str]:
    """A text in parts of TOGETHER characters at most, cut behind a blank where there is one."""
    out, at = [], 0
    while len(text) - at > TOGETHER:
        to = max(text.rfind(" ", at, at + TOGETHER), text.rfind("\n", at, at + TOGETHER)) + 1 or at + TOGETHER
        out.append(text[at:to])
        at = to
    return [*out, text[at:]]


def together(texts: list[str | None]) -> Iterator[tuple[list[int], list[str]]]:
    """Parts of the texts that aren't blank, about TOGETHER characters at a time, with the number of each part's text."""
    of, parts, size = [], [], 0
    for i, t in enumerate(texts):
        for part in cut_up(t) if t and t.strip() else []:
            of.append(i)
            parts.append(part)
            size += len(part)
            if size >= TOGETHER:
                yield of, parts
                of, parts, size = [], [], 0
    if parts:
        yield of, parts


def is_content(line: str, m: regex.Match) -> bool:
    """Whether a bracketed name is part of what was written: a control string, a cell, a letter, or a piece of code."""
    if CONTENT.fullmatch(m[0]):
        return True
    return m[0][0] in "[<" and m[0][:2] not in ("[[", "<<", "<%") and bool(IN_CODE.search(line[: m.start()][-1:]))


def best_run(ratios: np.ndarray) -> float:
    """The greatest sum of ratios that stand side by side, at least 0."""
    return best_span(ratios)[0]


def best_span(ratios: np.ndarray) -> tuple[float, int, int]:
    """The greatest sum of ratios that stand side by side, at least 0, and where they begin and end."""
    sums = np.concatenate([[0.0], np.cumsum(ratios, dtype=np.float64)])
    over = sums - np.minimum.accumulate(sums)
    end = int(over.argmax())
    return float(over[end]), int(sums[: end + 1].argmin()), end


#: What covers a text, by the numbers of covered_by.
CASES = ("filler", "notice", None)


def covered_by(size: np.ndarray) -> np.ndarray:
    """Number in CASES of what covers each text: filler by its length or share, notices by their share of what isn't menu."""
    filler, notice = size[:, CLASSES.index("filler")], size[:, CLASSES.index("notice")]
    rest = np.maximum(1, size.sum(axis=1) - size[:, CLASSES.index("chrome")])
    return np.where((filler >= FILLER_CHARS) | (filler / rest >= NOTICE_SHARE), 0, np.where(notice / rest >= NOTICE_SHARE, 1, 2))


class Models:
    """Log ratios of the classes: filler, notice and chrome against prose, unfilled against about."""

    def __init__(self, prose: np.ndarray, seed: int = 1):
        s = {k: counted(v, borders=k in CLASSES).astype(float) for k, v in samples(seed).items()}
        frequency = lambda c: c / max(1.0, c.sum()) + SMOOTHING
        natural = frequency(prose.astype(float))
        self.against_prose = np.log(np.stack([frequency(s[k]) / natural for k in CLASSES])).astype(np.float32)
        # Of each bucket the classes' log ratios and, last, what it gains at most as part of a run of filler.
        self.by_bucket = np.ascontiguousarray(np.vstack([self.against_prose, np.maximum(self.against_prose[CLASSES.index("filler")] - COST, 0)]).T)
        self.about = np.log(frequency(s["about"]) / frequency(s["unfilled"])).astype(np.float32)
        self.about[(s["about"] == 0) & (s["unfilled"] == 0)] = -UNKNOWN

    def scored(self, w: Windows) -> tuple[np.ndarray, np.ndarray]:
        """Number of each window's class, PROSE for all natural ones; and the sum of what its n-grams gain as filler."""
        ratios = self.by_bucket[w.buckets]
        sums = w.sums(ratios)
        best = sums[:, : len(CLASSES)].argmax(axis=1)
        sure = sums[:, : len(CLASSES)].max(axis=1, initial=0.0) > np.maximum(MARGIN * w.lengths(), LEAST)
        return np.where(sure & (best < NATURAL), best, PROSE), sums[:, -1]

    def _filler_run(self, part: str) -> int:
        """Characters of the filler within a window that is prose as a whole."""
        part = prepared(QUOTED.sub(" ", part))
        g = grams(part)
        filler, mention, everyday = (self.against_prose[CLASSES.index(c), g] for c in ("filler", "mention", "everyday"))
        mention = np.maximum(mention, everyday)
        most, begin, end = best_span(filler - np.maximum(mention, 0) - COST)
        mention = mention - np.maximum(filler, 0)  # the filler's own words, which texts about it have too
        if most <= FILLER_RUN or max(best_run(mention[:begin] - COST), best_run(mention[end:] - COST)) > MENTION_RUN:
            return 0
        return min(end - begin + N - 1, len(part))

    def placeholders(self, text: str) -> bool:
        """Whether a placeholder stands unfilled in the text. Windows are what stands around it in its sentence."""
        return any(self._unfilled(line) for line in LINE.split(text))

    def _unfilled(self, line: str) -> bool:
        found = list(PLACEHOLDER.finditer(line))
        if not found:
            return False
        marked = PLACEHOLDER.sub("\ue000", line)
        at = -1
        for m in found:
            at = marked.index("\ue000", at + 1)
            if is_content(line, m):
                continue
            left = SENTENCE.split(marked[max(0, at - 60) : at])[-1]
            right = AFTER.split(marked[at + 1 : at + 60])[0]
            around = OPENING.sub("", left + "@" + right).replace("\ue000", "@")
            if best_run(self.about[grams(prepared(around))]) <= EVIDENCE:
                return True
        return False

    def sized(self, w: Windows, texts: int) -> np.ndarray:
        """Characters of each text by class, a row a text: CLASSES in their order, then prose."""
        size = np.zeros((texts, PROSE + 1), np.int64)
        classes, gains = self.scored(w)
        runs = np.zeros(len(w.of), np.int64)
        for k in np.flatnonzero((classes == PROSE) & (gains > FILLER_RUN)):  # no other window can hold a run
            runs[k] = self._filler_run(w.text(k))
        np.add.at(size, (w.of, classes), w.lengths() - runs)
        np.add.at(size, (w.of, CLASSES.index("filler")), runs)
        return size

    def verdicts(self, texts: list[str | None]) -> list[tuple[str | None, int, int]]:
        """Of each text the reason that makes it a case (None: natural), characters of residue, characters in all."""
        size = np.zeros((len(texts), PROSE + 1), np.int64)
        for of, parts in together(texts):
            np.add.at(size, of, self.sized(windows(parts), len(parts)))
        out = []
        for t, (filler, notice, chrome, _, _, prose), case in zip(texts, size.tolist(), covered_by(size), strict=True):
            total = filler + notice + chrome + prose
            if t and MARKED.search(t) and self.placeholders(t):
                out.append(("placeholder", filler + notice, total))
            else:
                out.append((CASES[case], (filler, notice, filler + notice)[case], total))
        return out

    def judged(self, text: str | None) -> tuple[str | None, int, int]:
        return self.verdicts([text])[0]


def counts_of(parts: list[str], model: Models | None = None) -> np.ndarray:
    """n-gram counts of texts, or of those of them that a model sees no filler and no notice in."""
    w = windows(parts)
    if model is not None:
        natural = covered_by(model.sized(w, len(parts))) == CASES.index(None)
        keep = natural[w.of]
        w = Windows(w.codes, w.buckets, w.of[keep], w.begin[keep], w.end[keep])
    return np.bincount(w.buckets[w.covered()], minlength=BUCKETS)


def prose_counts(documents: DataFrame, text: str, model: Models | None = None) -> np.ndarray:
    """n-gram counts over all texts, or over those in which a first model sees no filler and no notice.

    Each task counts into an array of BUCKETS numbers; their sums, never more than BUCKETS rows, go to the driver.
    """
    held = documents.sparkSession.sparkContext.broadcast(model)  # 2^18 numbers a class, whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, m = np.zeros(BUCKETS, np.int64), held.value
        for b in batches:
            for _, parts in together(b.column(0).to_pylist()):
                own += counts_of(parts, m)
        at = np.nonzero(own)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(own[at])], ["bucket", "n"])

    sums = documents.select(F.col(text)).mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS, np.int64)
    got = sums.toArrow()
    out[got.column("bucket").to_numpy()] = got.column("n").to_numpy()
    return out


def fitted(documents: DataFrame, text: str) -> Models:
    """Models whose prose is counted twice: over all texts, then over the texts that the first models call natural."""
    first = Models(prose_counts(documents, text))
    return Models(prose_counts(documents, text, first))


def judged(documents: DataFrame, key: str, text: str, models: Models | None = None) -> DataFrame:
    """(key, reason, residue_chars, chars) of every document; reason is placeholder, filler or notice, null if natural.

    Null, empty and blank texts are natural with 0 characters. Nothing is shuffled.
    """
    models = models or fitted(documents, text)
    held = documents.sparkSession.sparkContext.broadcast(models)
    kind = dict(documents.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for b in batches:
            got = m.verdicts(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.int64()), pa.array([g[2] for g in got], pa.int64())], [key, "reason", "residue_chars", "chars"])

    return documents.select(key, text).mapInArrow(run, f"`{key}` {kind}, reason string, residue_chars bigint, chars bigint")
