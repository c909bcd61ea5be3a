"""Fill-in-the-middle transformation by secondary-sort assembly (op 12).

A text is cut into ``n`` code points. ``h1`` to ``h4`` are the first four 8-digit groups of the SHA-256 of the salt and
the decimal ``doc_id``; they choose the two cuts (prefix, middle, suffix) and the form: ``plain`` leaves the text as it is,
``psm`` gives ``<P>`` prefix ``<S>`` suffix ``<M>`` middle, ``spm`` gives ``<S>`` suffix ``<P>`` prefix ``<M>`` middle. A text
that is empty or holds one of the three marks is always plain.

Every text becomes pieces of at most ``CHUNK`` code points, keyed by document and place in the output.
``repartitionAndSortWithinPartitions`` brings a document's pieces together in output order, and a task streams them into
the output's digest, however long the text is. The same stream is read back as a reader of the output would: the marks
are searched in the text, and what lies between them is keyed by its place in the original. The second
``repartitionAndSortWithinPartitions`` has the same partitioner, so that it sorts (and spills) within the tasks without
another shuffle; its stream goes into the digest of the restored text. The number of tasks follows the bytes of
all texts, which Spark adds up first.

A document is one row: rows are keyed by their number, not by ``doc_id``, so that repeated ids and hot ids stay apart.
``docs`` should be a stored table. A null text is the empty text; a null ``doc_id`` hashes as an empty string and comes
back as null; repeated rows are repeated in the result; an empty table gives an empty result; very long texts pass in
pieces. Only ``doc_id`` and ``text`` are read, whatever other columns are called.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Code points of a piece, and bytes of text that a task sorts and streams.
CHUNK, TASK_BYTES = 1 << 15, 64 << 20
#: Fixed values of the format: marks, and the order in which a form writes the sections.
PREFIX, MIDDLE, SUFFIX = 0, 1, 2
MARKS = {PREFIX: "<P>", SUFFIX: "<S>", MIDDLE: "<M>"}
FORMS = {"plain": (), "psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
PLAIN_FROM, SPM_BELOW, SALT = 90, 20, "1:"
#: Places of the sections of the restored text lie this far apart (a text is shorter).
_SECTION = 1 << 40


def choose(digest: str, text: str) -> tuple[str, int, int]:
    """Form, end of the prefix and end of the middle, in code points, by the hex digest of the document."""
    h1, h2, h3, h4 = (int(digest[k:k + 8], 16) for k in (0, 8, 16, 24))
    a, b = sorted((h1 % (len(text) + 1), h2 % (len(text) + 1)))
    if not text or any(m in text for m in MARKS.values()) or h3 % 100 >= PLAIN_FROM:
        return "plain", a, b
    return ("spm" if h4 % 100 < SPM_BELOW else "psm"), a, b


def pieces(rows: Iterator) -> Iterator[tuple[tuple[int, int], object]]:
    """((row, place), piece): at place 0 the document's head, then its output in order."""
    for r in rows:
        text = r.text or ""
        form, a, b = choose(r.digest, text)
        ends = {PREFIX: (0, a), MIDDLE: (a, b), SUFFIX: (b, len(text))}
        yield (r.row, 0), (r.doc_id, len(text), form, None if form == "plain" else a, None if form == "plain" else b - a)
        place = 1
        for mark, start, end in ([(MARKS[s], *ends[s]) for s in FORMS[form]] or [("", 0, len(text))]):
            for at in range(start, max(end, start + 1), CHUNK):
                yield (r.row, place), mark + text[at:min(at + CHUNK, end)]
                mark, place = "", place + 1


class Reader:
    """Reads an output piece by piece and gives its sections' text with their places in the original."""

    def __init__(self, form: str):
        self.due = list(FORMS[form])
        self.section, self.rest, self.place = PREFIX, "", 0

    def _out(self, text: str):
        if text:
            self.place += 1
            yield self.section * _SECTION + self.place, text

    def feed(self, text: str) -> Iterator[tuple[int, str]]:
        text = self.rest + text
        self.rest = ""
        while self.due:
            at = text.find(MARKS[self.due[0]])
            if at < 0:  # a mark may be cut by the end of the piece
                keep = max(0, len(text) - 2)
                yield from self._out(text[:keep])
                self.rest = text[keep:]
                return
            yield from self._out(text[:at])
            text = text[at + len(MARKS[self.due[0]]):]
            self.section, self.place = self.due.pop(0), 0
        yield from self._out(text)

    def end(self) -> Iterator[tuple[int, str]]:
        yield from self._out(self.rest)


def _update(digest, kept: list | None, text: str) -> None:
    digest.update(text.encode("utf-8", "surrogatepass"))
    if kept is not None:
        kept.append(text)


def read_back(stream: Iterator, texts: bool) -> Iterator[tuple[tuple[int, int], object]]:
    """From sorted output pieces: the head with the output's digest at place -1, and the restored text's pieces."""
    row = head = digest = kept = reader = None

    def close():
        for place, text in reader.end():
            yield (row, place), text
        yield (row, -1), (*head, digest.hexdigest(), "".join(kept) if texts else None)

    for (r, place), piece in stream:
        if place == 0:
            if row is not None:
                yield from close()
            row, head, digest, kept, reader = r, piece, hashlib.sha256(), [] if texts else None, Reader(piece[2])
            continue
        _update(digest, kept, piece)
        for at, text in reader.feed(piece):
            yield (row, at), text
    if row is not None:
        yield from close()


def restored(stream: Iterator, texts: bool) -> Iterator[tuple]:
    """From sorted pieces of the restored texts: one result row a document."""
    head = digest = kept = None

    def close():
        return (*head, digest.hexdigest(), "".join(kept) if texts else None)

    for (_, place), piece in stream:
        if place < 0:
            if head is not None:
                yield close()
            head, digest, kept = piece, hashlib.sha256(), [] if texts else None
        else:
            _update(digest, kept, piece)
    if head is not None:
        yield close()


def _spread(key: tuple[int, int]) -> int:
    """Partition of a document: row numbers mixed, so that neighbours part."""
    return (key[0] * 0x9E3779B97F4A7C15 >> 20) & 0x7FFFFFFF


def fill_in_middle(docs: DataFrame, salt: str = SALT, texts: bool = False) -> DataFrame:
    """``doc_id``, ``n``, ``form``, ``prefix_chars``, ``middle_chars``, ``output_sha256``, ``restored_sha256`` per row.

    With ``texts`` also ``output`` and ``restored`` themselves; a task then holds one text at a time whole.
    """
    spark = docs.sparkSession
    identity = F.concat(F.lit(salt), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text"), F.sha2(identity, 256).alias("digest")).rdd
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    n = max(-(-size // TASK_BYTES), int(spark.conf.get("spark.sql.shuffle.partitions")))
    output = rows.mapPartitions(pieces).repartitionAndSortWithinPartitions(n, _spread)
    back = output.mapPartitions(lambda s: read_back(s, texts), preservesPartitioning=True)
    result = back.repartitionAndSortWithinPartitions(n, _spread).mapPartitions(lambda s: restored(s, texts))
    schema = ("doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, "
              "output string, restored_sha256 string, restored string")
    out = spark.createDataFrame(result, schema, verifySchema=False)
    return out if texts else out.drop("output", "restored")
