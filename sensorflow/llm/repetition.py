"""Quality rules on repetition, from a suffix array over the words of each document.

A slice of documents is sorted together by prefix doubling, with the document as the
leading key, so suffixes meet only within their document; after each doubling only the
suffixes that still share their rank are sorted again.  Neighbours' longest common
prefixes follow from the ranks of all levels.  A position whose longest repeat isn't the
tail of the one before starts a maximal repeated substring; their spans are united.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.llm.common import as_bytes, id_and_text, slices

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 20
#: words of the base rule's windows, and the percentage of words in repeated ones that fails
BASE_WINDOW, BASE_PERCENT = 8, 30
#: the method's own limits: least repeat in words, covered share of the characters, longest repeat in words
MIN_REPEAT, MAX_COVERED, MAX_LONGEST = 4, 0.30, 60


def longest_repeats(words: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Per position, the most words from there that also start elsewhere in the same document.

    ``words``: ids; ``doc``: ascending document numbers.
    """
    n = len(words)
    best = np.zeros(n, np.int64)
    if n < 2:
        return best
    end = np.searchsorted(doc, doc, "right")
    width = int(words.max()) + 1
    order = np.argsort(doc * width + words, kind="stable")
    key = (doc * width + words)[order]
    first = np.concatenate([[True], key[1:] != key[:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    levels, h = [], 1
    while True:
        levels.append(rank.astype(np.int32))
        # places in the order whose rank is shared
        start = rank[order]
        shared = np.zeros(n, bool)
        same = start[1:] == start[:-1]
        shared[1:] |= same
        shared[:-1] |= same
        at = np.flatnonzero(shared)
        if not len(at):
            break
        pos = order[at]
        nxt = pos + h
        second = np.where(nxt < end[pos], rank[np.minimum(nxt, n - 1)], -1)
        by = np.lexsort((second, rank[pos]))
        pos, second, old = pos[by], second[by], rank[pos[by]]
        order[at] = pos
        # a text's last h words equal nothing longer: each such suffix gets a rank of its own
        first = np.concatenate([[True], (old[1:] != old[:-1]) | (second[1:] != second[:-1]) | (second[1:] < 0)])
        rank = rank.copy()
        rank[pos] = np.maximum.accumulate(np.where(first, at, 0))
        h *= 2
    left, right = order[:-1].copy(), order[1:].copy()
    common = np.zeros(n - 1, np.int64)
    for k in range(len(levels) - 1, -1, -1):
        a, b = left + common, right + common
        ok = (a < n) & (b < n)
        a, b = np.minimum(a, n - 1), np.minimum(b, n - 1)
        common += (ok & (levels[k][a] == levels[k][b])) * (1 << k)
    best[order[:-1]] = common
    best[order[1:]] = np.maximum(best[order[1:]], common)
    return best


def united_spans(best: np.ndarray, doc: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the union of all maximal repeats of ``least`` words or more."""
    starts = np.flatnonzero(best >= least)
    if len(starts):  # the tail of the repeat before adds nothing
        maximal = (starts == 0) | (doc[starts - 1] != doc[starts]) | (best[starts - 1] != best[starts] + 1)
        starts = starts[maximal]
    edge = np.zeros(len(best) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + best[starts], -1)
    covered = (edge.cumsum() > 0)[:-1]
    new_doc = np.concatenate([[True], doc[1:] != doc[:-1]]) if len(doc) else np.zeros(0, bool)
    begins = np.flatnonzero(covered & (np.concatenate([[True], ~covered[:-1]]) | new_doc)) if len(doc) else starts
    ends_at = np.flatnonzero(covered & (np.concatenate([~covered[1:], [True]])
                                        | np.concatenate([new_doc[1:], [True]]))) + 1 if len(doc) else starts
    return begins, ends_at


SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "longest_repeat long, covered_chars long, repeats array<struct<start:long,end:long>>")


def repetition(docs: DataFrame, min_repeat: int = MIN_REPEAT, base_window: int = BASE_WINDOW) -> DataFrame:
    """Counts and repeated spans (in words, united) of every whole text.

    Words are runs of characters other than ``\\x20`` and ``\\x09-\\x0D``.  A null or empty
    text has no words: all counts 0, no spans.  Null and repeated ids give one row per
    input row; an empty table gives no rows; only ``doc_id`` and ``text`` are read.
    """

    def measure(batches):
        for piece in slices(batches):
            texts = as_bytes(piece.column("text"))
            split = [t.split() for t in texts]
            n_words = np.array([len(w) for w in split], np.int64)
            flat = [w for ws in split for w in ws]
            number = {w: i for i, w in enumerate(dict.fromkeys(flat))}
            words = np.fromiter(map(number.__getitem__, flat), np.int64, len(flat))
            points = {w: len(w.decode()) for w in number}
            chars = np.fromiter(map(points.__getitem__, flat), np.int64, len(flat))
            doc = np.repeat(np.arange(len(texts)), n_words)
            best = longest_repeats(words, doc)
            per_doc = lambda x, b, e: np.bincount(
                doc[b], (np.concatenate([[0], np.cumsum(x)]))[e] - (np.concatenate([[0], np.cumsum(x)]))[b],
                minlength=len(texts)).astype(np.int64)
            b8, e8 = united_spans(best, doc, base_window)
            b, e = united_spans(best, doc, min_repeat)
            first = np.cumsum(n_words) - n_words
            longest = np.zeros(len(texts), np.int64)
            np.maximum.at(longest, doc, best)
            offsets = np.searchsorted(doc[b], np.arange(len(texts) + 1)) if len(b) else np.zeros(len(texts) + 1)
            lines = [[x for x in t.split(b"\n") if x.strip()] for t in texts]
            at = doc[b]
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(n_words), pa.array(np.bincount(
                    doc, chars, minlength=len(texts)).astype(np.int64)),
                 pa.array([len(t) - len(t.translate(None, SYMBOLS)) for t in texts], pa.int64()),
                 pa.array([len(x) - len(set(x)) for x in lines], pa.int64()),
                 pa.array(per_doc(np.ones(len(flat), np.int64), b8, e8)), pa.array(longest),
                 pa.array(per_doc(chars, b, e)),
                 pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(
                     [pa.array(b - first[at], pa.int64()), pa.array(e - first[at], pa.int64())], ["start", "end"]))],
                [f.split(" ")[0] for f in SCHEMA.replace("start:long,end:long", "").split(", ")])

    return id_and_text(docs).mapInArrow(measure, SCHEMA)


def with_verdict(measured: DataFrame, max_covered: float = MAX_COVERED, max_longest: int = MAX_LONGEST) -> DataFrame:
    """``base_failed`` and ``kept``: the base rules, then limits on the covered share and the longest repeat."""
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > BASE_PERCENT * F.col("n_words"))
    ok = (F.col("covered_chars") <= max_covered * F.col("word_chars")) & (F.col("longest_repeat") <= max_longest)
    return measured.withColumns({"base_failed": failed, "kept": ~failed & ok})


def _oracle(levels: int = 17) -> str:
    """DuckDB twin, for texts of fewer than ``2**levels`` words.

    ``d<k>`` numbers the runs of ``2**k`` words that a text holds twice or more; ``c<k>`` has the places of
    the longest repeat found so far, which longer runs extend from the largest power down.
    """
    parts = [r"""w AS MATERIALIZED (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
x AS MATERIALIZED (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM w),
d0 AS MATERIALIZED (SELECT doc_id, p, dense_rank() OVER (PARTITION BY doc_id ORDER BY word) AS r FROM x
  QUALIFY count(*) OVER (PARTITION BY doc_id, word) > 1)"""]
    parts += [f"""d{k} AS MATERIALIZED (SELECT a.doc_id, a.p, dense_rank() OVER (PARTITION BY a.doc_id ORDER BY a.r, b.r) AS r
  FROM d{k - 1} a JOIN d{k - 1} b ON a.doc_id = b.doc_id AND b.p = a.p + {1 << k - 1}
  QUALIFY count(*) OVER (PARTITION BY a.doc_id, a.r, b.r) > 1)""" for k in range(1, levels)]
    parts.append(f"c{levels} AS (SELECT doc_id, p, 0 AS n, 0 AS r FROM x)")
    parts += [f"""e{k} AS MATERIALIZED (
  SELECT c.doc_id, c.p, c.n + {1 << k} AS n, dense_rank() OVER (PARTITION BY c.doc_id ORDER BY c.r, d.r) AS r
  FROM c{k + 1} c JOIN d{k} d ON d.doc_id = c.doc_id AND d.p = c.p + c.n QUALIFY count(*) OVER (PARTITION BY c.doc_id, c.r, d.r) > 1),
c{k} AS MATERIALIZED (FROM e{k} UNION ALL FROM c{k + 1} WHERE doc_id NOT IN (SELECT doc_id FROM e{k}))"""
              for k in reversed(range(levels))]
    failed = f"(n_words < {MIN_WORDS} OR 100 * n_repeat_words > {BASE_PERCENT} * n_words)"
    parts.append(rf"""b AS (SELECT DISTINCT doc_id, unnest(range(p, p + {BASE_WINDOW})) AS p FROM d{BASE_WINDOW.bit_length() - 1}),
m AS (SELECT DISTINCT doc_id, unnest(range(p, p + {MIN_REPEAT})) AS p FROM d{MIN_REPEAT.bit_length() - 1}),
chars AS (SELECT x.doc_id, sum(length(word)) AS n, sum(length(word)) FILTER (WHERE m.p IS NOT NULL) AS covered
          FROM x LEFT JOIN m ON m.doc_id = x.doc_id AND m.p = x.p GROUP BY x.doc_id),
lines AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n
          FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM w)
          WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
many AS (SELECT doc_id, count(*) AS n FROM b GROUP BY doc_id),
longest AS (SELECT doc_id, max(n) AS n FROM c0 GROUP BY doc_id),
a AS (SELECT doc_id, len(ws) AS n_words, coalesce(chars.n, 0)::BIGINT AS word_chars,
             len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, coalesce(lines.n, 0) AS n_dup_lines,
             coalesce(many.n, 0) AS n_repeat_words, coalesce(longest.n, 0)::BIGINT AS longest_repeat,
             coalesce(covered, 0)::BIGINT AS covered_chars
      FROM w LEFT JOIN chars USING (doc_id) LEFT JOIN lines USING (doc_id) LEFT JOIN many USING (doc_id) LEFT JOIN longest USING (doc_id))
SELECT *, {failed} AS base_failed,
       NOT {failed} AND covered_chars <= {MAX_COVERED}::DOUBLE * word_chars AND longest_repeat <= {MAX_LONGEST} AS kept
FROM a""")
    return "WITH " + ",\n".join(parts)


#: the base window and the least repeat are powers of two
ORACLE = _oracle()
