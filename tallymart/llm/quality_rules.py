"""Line-first cleaning: rules judge each line, failed lines go, and a document that loses too much text is rejected.

A line with a word fails if it is
- navigation: at least `bars` of its words hold one of | > » • and they are at least a third of the words, or
- symbols: characters of #*$%&|<> are more than a tenth of the code points in its words, or
- shouting: at least 5 words of two letters or more, and more than half of them have capitals only, or
- boilerplate: it holds a phrase of BOILERPLATE, or
- unpunctuated: the line is `long_line` words or longer and has no mark of .!?:;,… or their wide forms anywhere, or
- stuttering: at least 10 words, and more than half of them equal the word before.
The method's verdict rejects a document if the words of failed lines hold more than `max_lost` per cent of all code points in words.

base() gives the plain counts of a text, from the same scan. Defined cases: a null text has no words and, as it has fewer than 20,
fails; equal rows get equal results; no line can fail in an empty text; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm import scan
from tallymart.llm.shared import KEY, PRINT, id_back, keyed, table

#: Characters that count as symbols, as separators of navigation entries, and phrases of boilerplate lines.
SYMBOLS = b"#*$%&|<>"
BOILERPLATE = [
    "all rights reserved",
    "cookie policy",
    "enable javascript",
    "licensed under",
    "lorem ipsum",
    "privacy policy",
    "sign up for our newsletter",
    "subscribe to our",
    "terms of service",
    "terms of use",
]
BAR = "[|>»•]"
MARK = "[.!?:;,…。！？，]"

IS_SYMBOL = np.zeros(256, bool)
IS_SYMBOL[list(SYMBOLS)] = True
WINDOW = 8

FIELDS = {
    "n_words": "long",
    "word_chars": "long",
    "n_symbols": "long",
    "n_dup_lines": "long",
    "n_repeat_words": "long",
    "lost_chars": "long",
    "n_lines": "long",
    "n_failed_lines": "long",
    "kept_text": "string",
}
OUT = pa.schema([(KEY, pa.int64()), (PRINT, pa.int64()), *[(k, pa.int64() if t == "long" else pa.large_string()) for k, t in FIELDS.items()]])


class Page:
    """Words and lines of a slice, and the counts that rules and features are made of."""

    def __init__(self, texts: scan.Texts):
        self.texts, buf, off = texts, texts.buf, texts.off
        self.words = words = scan.Words(texts)
        self.hash = words.hashes()
        self.starts = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
        self.chars = self.starts[words.end] - self.starts[words.start]
        self.doc = np.repeat(np.arange(len(texts)), words.counts())
        symbol = np.concatenate([[0], np.cumsum(IS_SYMBOL[buf])])
        self.symbols = symbol[words.end] - symbol[words.start]
        self.n_symbols = np.diff(symbol[off])
        breaks = np.flatnonzero(buf == 0x0A)
        self.line_start = np.sort(np.concatenate([off[:-1], breaks + 1]), kind="stable")
        self.line_end = np.sort(np.concatenate([off[1:], breaks]), kind="stable")
        self.first_line = np.arange(len(off)) + np.searchsorted(breaks, off)
        self.line_doc = np.repeat(np.arange(len(texts)), np.diff(self.first_line))
        # Words of a line: from line_word[i] to line_word[i + 1].
        self.line_word = np.append(np.searchsorted(words.start, self.line_start), len(words.start))
        self.line_word[-1] = len(words.start)
        self.line_words = np.searchsorted(words.start, self.line_end) - self.line_word[:-1]

    def by_line(self, values: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(values)])
        return total[self.line_word[:-1] + self.line_words] - total[self.line_word[:-1]]

    def by_doc(self, values: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(values)])
        return total[self.words.first[1:]] - total[self.words.first[:-1]]

    def lines(self) -> pa.Array:
        """Every line as an Arrow string, without copying."""
        off = np.append(self.line_start, len(self.texts.buf))
        # A line's break belongs to it here; rules do not look at breaks.
        return pa.LargeStringArray.from_buffers(len(self.line_start), pa.py_buffer(off.astype(np.int64)), pa.py_buffer(self.texts.buf))

    def repeated_words(self) -> np.ndarray:
        """True for words in a window of eight words found twice or more in the same text, the first one included."""
        n = len(self.hash)
        hit = np.zeros(n + 1, np.int64)
        windows = scan.grams(self.hash, WINDOW)
        at = np.flatnonzero(self.doc[: len(windows)] == self.doc[WINDOW - 1 :]) if len(windows) else np.zeros(0, np.int64)
        h = scan.mix(windows[at] + scan.mix(self.doc[at].astype(np.uint64)))
        order = np.argsort(h, kind="stable")
        same = h[order][1:] == h[order][:-1]
        twice = np.zeros(len(at), bool)
        twice[1:] |= same
        twice[:-1] |= same
        twin = at[order[twice]]
        np.add.at(hit, twin, 1)
        np.add.at(hit, twin + WINDOW, -1)
        return np.cumsum(hit)[:n] > 0

    def duplicate_lines(self) -> np.ndarray:
        """True for lines with a word that equal an earlier line of the same text."""
        at = np.flatnonzero(self.line_words > 0)
        h = scan.spans_hash(scan.byte_sums(self.texts.buf), self.line_start[at], self.line_end[at])
        h = scan.mix(h + scan.mix(self.line_doc[at].astype(np.uint64)))
        order = np.argsort(h, kind="stable")
        out = np.zeros(len(self.line_start), bool)
        out[at[order[1:][h[order][1:] == h[order][:-1]]]] = True
        return out

    def capitals(self) -> tuple[np.ndarray, np.ndarray]:
        """For each word: the number of ASCII letters, and of those that are capitals."""
        buf = self.texts.buf
        upper = (buf >= 0x41) & (buf <= 0x5A)
        letter = upper | ((buf >= 0x61) & (buf <= 0x7A))
        a, b = (np.concatenate([[0], np.cumsum(x)]) for x in (letter, upper))
        return a[self.words.end] - a[self.words.start], b[self.words.end] - b[self.words.start]

    def stutter(self) -> np.ndarray:
        """True for words that equal the word before in the same text."""
        out = np.zeros(len(self.hash), bool)
        out[1:] = (self.hash[1:] == self.hash[:-1]) & (self.doc[1:] == self.doc[:-1])
        return out


def failed_lines(page: Page, bars: int, long_line: int) -> np.ndarray:
    n, lines = page.line_words, page.lines()
    has = lambda pattern: pc.match_substring_regex(lines, pattern).to_numpy(zero_copy_only=False)
    chars, symbols = page.by_line(page.chars), page.by_line(page.symbols)
    letters, capitals = page.capitals()
    word = letters >= 2
    words, shouted = page.by_line(word), page.by_line(word & (capitals == letters))
    fail = (10 * symbols > chars) | ((words >= 5) & (2 * shouted > words))
    bar = pc.count_substring_regex(lines, BAR).to_numpy(zero_copy_only=False)
    fail |= (bar >= bars) & (3 * bar >= n)
    fail |= has("(?i)" + "|".join(BOILERPLATE))
    fail |= (n >= long_line) & ~has(MARK)
    fail |= (n >= 10) & (2 * page.by_line(page.stutter()) > n)
    return fail & (n > 0)


def _judged(bars: int, long_line: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, prints = b.column(KEY).to_numpy(), b.column(PRINT).to_numpy()
            for i, j, texts in scan.slices(b.column("text")):
                page = Page(texts)
                fail = failed_lines(page, bars, long_line)
                lines = np.diff(page.first_line)
                bad = np.bincount(page.line_doc[fail], minlength=j - i)
                chars = page.by_line(page.chars)
                lost = np.bincount(page.line_doc[fail], weights=chars[fail], minlength=j - i).astype(np.int64)
                text = [_without(page, fail, d) if bad[d] else texts.buf[texts.off[d] : texts.off[d + 1]].tobytes() for d in range(j - i)]
                yield scan.batch(
                    OUT,
                    keys[i:j],
                    prints[i:j],
                    page.words.counts(),
                    page.by_doc(page.chars),
                    page.n_symbols,
                    np.bincount(page.line_doc[page.duplicate_lines()], minlength=j - i),
                    page.by_doc(page.repeated_words()),
                    lost,
                    lines,
                    bad,
                    pa.array(text, pa.large_binary()).cast(pa.large_string()),
                )

    return run


def _without(page: Page, fail: np.ndarray, d: int) -> bytes:
    at = range(page.first_line[d], page.first_line[d + 1])
    return b"\n".join(page.texts.buf[page.line_start[k] : page.line_end[k]].tobytes() for k in at if not fail[k])


def judge(docs: DataFrame, bars: int = 3, long_line: int = 25, max_lost: int = 50) -> DataFrame:
    """Row key, the counts of each text, kept_text (the lines that pass), base_failed and kept. No shuffle: texts are judged alone."""
    out = keyed(docs).mapInArrow(_judged(bars, long_line), ", ".join([f"{KEY} long", f"{PRINT} long", *[f"{k} {t}" for k, t in FIELDS.items()]]))
    base_failed = (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)
    return out.withColumn("base_failed", base_failed).withColumn("kept", ~base_failed & (F.col("lost_chars") * 100 <= F.col("word_chars") * max_lost))


def op8_quality_rules(spark, sf_dir) -> DataFrame:
    judged = judge(table(spark, sf_dir, "documents"))
    return judged.select(id_back(), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


#: The rules in SQL, on lists of words; the constants are those above.
SQL = {
    "op8_quality_rules": r"""
WITH lines AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
cut AS (SELECT *, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS w FROM lines),
measured AS (SELECT *, len(w) AS n, list_sum(list_transform(w, lambda x: length(x))) AS chars,
    len(regexp_extract_all(line, '[#*$%&|<>]')) AS symbols,
    len(list_filter(w, lambda x: len(regexp_extract_all(x, '[A-Za-z]')) >= 2)) AS words,
    len(list_filter(w, lambda x: len(regexp_extract_all(x, '[A-Za-z]')) >= 2 AND len(regexp_extract_all(x, '[a-z]')) = 0)) AS shouted,
    len(regexp_extract_all(line, '[|>\x{BB}\x{2022}]')) AS bars,
    row_number() OVER (PARTITION BY doc_id, line ORDER BY i) AS copy
  FROM cut),
words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
numbered AS (SELECT doc_id, i, unnest(list_transform(range(1, len(w) + 1), lambda k: k)) AS k, unnest(w) AS word FROM cut),
steps AS (SELECT doc_id, i, word, lag(word) OVER (PARTITION BY doc_id ORDER BY i, k) AS before FROM numbered),
stutters AS (SELECT doc_id, i, count(*) FILTER (WHERE word = before) AS stutter FROM steps GROUP BY doc_id, i),
judged AS (SELECT m.*, n > 0 AND (10 * symbols > chars OR (words >= 5 AND 2 * shouted > words) OR (bars >= 3 AND 3 * bars >= n)
    OR regexp_matches(line, '(?i)all rights reserved|cookie policy|enable javascript|licensed under|lorem ipsum|privacy policy|sign up for our newsletter|subscribe to our|terms of service|terms of use')
    OR (n >= 25 AND NOT regexp_matches(line, '[.!?:;,\x{2026}\x{3002}\x{FF01}\x{FF1F}\x{FF0C}]'))
    OR (n >= 10 AND 2 * coalesce(stutter, 0) > n)) AS fail
  FROM measured m LEFT JOIN stutters s ON s.doc_id = m.doc_id AND s.i = m.i),
totals AS (SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_words, CAST(coalesce(sum(chars), 0) AS BIGINT) AS word_chars, CAST(sum(symbols) AS BIGINT) AS n_symbols,
    count(*) FILTER (WHERE n > 0 AND copy > 1) AS n_dup_lines, coalesce(sum(chars) FILTER (WHERE fail), 0) AS lost FROM judged GROUP BY doc_id),
windows AS (SELECT doc_id, unnest(range(1, len(w) - 6)) AS p, w FROM words WHERE len(w) >= 8),
said AS (SELECT doc_id, p, array_to_string(w[p:p + 7], ' ') AS s FROM windows),
twice AS (SELECT doc_id, p FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, s) AS c FROM said) WHERE c > 1),
repeats AS (SELECT doc_id, count(DISTINCT place) AS n_repeat_words FROM (SELECT doc_id, unnest(range(p, p + 8)) AS place FROM twice) GROUP BY doc_id),
every AS (SELECT t.*, coalesce(n_repeat_words, 0) AS n_repeat_words FROM totals t LEFT JOIN repeats USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND 100 * lost <= 50 * word_chars AS kept
FROM every
"""
}
QUERIES = {"op8_quality_rules": op8_quality_rules}
