"""Token-id files: independent zstandard frames with a trailing seek table.

A file holds the documents of one ascending range of ids.  Each document is a
frame of its own (little-endian unsigned ids, of 16 bits if the vocabulary has no
greater ones and else of 32, closed by the end id; a document above ``FRAME_IDS``
ids spans several), with the content size and a content checksum in it.  The file ends in a skippable frame with the seek table
of the public zstandard seekable format: per frame its compressed size, raw size
and checksum (low 32 bits of XXH64), then the number of frames, a descriptor and
the magic number.  Any zstandard tool can unpack the whole file; ``read_ids``
reads the table, seeks, and unpacks only the frames that are asked for.

Files are written by the tasks to the shared folder under a name of the attempt
and then renamed, so a repeated task replaces whole files by equal ones.  Where
each document lies is kept in a Parquet index beside them.

Edge cases: null text is the empty text (the end id alone); a null id sorts
first; repeated rows are kept, ties ordered by text; a very long text becomes several frames;
an empty table writes no files and gives an empty index; other columns than id and text are not read, so their
names do not matter.  A worker keeps the words it has met, two generations of bounded size, for its life.
"""

from __future__ import annotations

import struct
from string import punctuation

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.common import laid_out, release_memory, runs_of, shared_path, text_or_empty, written
from kestrel.session import ship_package

FRAME_IDS = 1 << 26
# Fixed values of the public seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEK_TABLE_MAGIC = 0x8F92EAB1
WITH_CHECKSUMS = 0x80

_INDEX = "doc_id long, file string, first_frame long, n_frames int, start_in_file long, n_tokens long, width int"


def open_folder(uri: str):
    """(file system, path) of a folder URI, for tasks that read or write it directly."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    if "://" in uri:
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri


class FrameWriter:
    """Appends frames to a binary stream; ``close`` adds the seek table."""

    def __init__(self, sink, level: int = 3):
        import zstandard

        self._sink, self._table = sink, []
        self._zip = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)

    def add(self, data: bytes) -> int:
        """Write one frame; returns its number."""
        import xxhash

        packed = self._zip.compress(data)
        self._sink.write(packed)
        self._table.append(struct.pack("<III", len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
        return len(self._table) - 1

    def close(self) -> None:
        body = b"".join(self._table) + struct.pack("<IBI", len(self._table), WITH_CHECKSUMS, SEEK_TABLE_MAGIC)
        self._sink.write(struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body)
        self._sink.close()


class FrameReader:
    """Random access to the frames of a seekable file."""

    def __init__(self, source):
        import numpy as np
        import zstandard

        self._source, self._unzip = source, zstandard.ZstdDecompressor()
        size = source.size()
        source.seek(size - 9)
        n, flags, magic = struct.unpack("<IBI", source.read(9))
        if magic != SEEK_TABLE_MAGIC or flags != WITH_CHECKSUMS:
            raise ValueError("no seek table with checksums at the end of the file")
        source.seek(size - 9 - 12 * n - 8)
        head = struct.unpack("<II", source.read(8))
        if head != (SKIPPABLE_MAGIC, 12 * n + 9):
            raise ValueError("damaged seek table")
        self._table = np.frombuffer(source.read(12 * n), "<u4").reshape(n, 3)
        self._at = np.concatenate([[0], np.cumsum(self._table[:, 0], dtype=np.int64)])

    def __len__(self) -> int:
        return len(self._table)

    def frame(self, k: int) -> bytes:
        import xxhash

        self._source.seek(int(self._at[k]))
        data = self._unzip.decompress(self._source.read(int(self._table[k, 0])))
        if len(data) != self._table[k, 1] or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != self._table[k, 2]:
            raise ValueError(f"frame {k} fails its checksum")
        return data


class WordIds:
    """Ids of whole texts by the tokenizers library, which sees each distinct word once.

    Texts are cut at spaces and line ends.  The vocabulary must drop white space
    and have no unit that spans it; the constructor checks this on its pattern, and
    otherwise whole texts go to the library.  ASCII punctuation at the end of a word,
    after a letter or digit, is a unit of its own, so such a word is put together from
    its stem; new words of letters go to the library in one text, cut again at the ids
    that end a word.  Latin-1 texts are lower-cased first if the vocabulary does so.

    Holds two generations of about ``limit`` words and no long ones.
    """

    def __init__(self, tokenizer_json: bytes, width: int = 4, limit: int = 600_000, longest: int = 48):
        import json
        import os

        import numpy as np

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._lib = Tokenizer.from_buffer(tokenizer_json)
        self._lib.no_truncation()
        self._lib.no_padding()
        spec = json.loads(tokenizer_json)
        steps = (spec["pre_tokenizer"] or {}).get("pretokenizers") or [spec["pre_tokenizer"] or {}]
        self._by_word = (steps[0].get("type") == "Split" and steps[0].get("behavior") == "Removed"
                         and bool(steps[0].get("invert"))
                         and not any(self._lib.encode(s, add_special_tokens=False).ids for s in (" ", "\n", " \n "))
                         and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or " " in t["content"]
                                     for t in spec["added_tokens"]))
        normal = spec["normalizer"] or {}
        self._lowers = any(n.get("type") == "Lowercase" for n in normal.get("normalizers", [normal]))
        self._marks = {t["content"][:2] for t in spec["added_tokens"]}
        suffix = spec["model"].get("end_of_word_suffix")
        self._ends = None
        if suffix:
            self._ends = np.zeros(self._lib.get_vocab_size(), bool)
            self._ends[[i for w, i in spec["model"]["vocab"].items() if w.endswith(suffix)]] = True
        self._young: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}
        self._long: set[str] = set()
        self._limit, self._longest = limit, longest
        self._kind, self._width = f"<u{width}", width

    def _encode(self, texts: list[str]) -> list[bytes]:
        """The library's ids of each text."""
        import numpy as np

        return [np.asarray(e.ids, self._kind).tobytes() for e in self._lib.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_words(self, words: list[str]) -> list[bytes]:
        import numpy as np

        if self._ends is None or not words:
            return self._encode(words)
        runs = [words[i:i + 512] for i in range(0, len(words), 512)]  # the library slows down on longer texts
        out: list[bytes] = []
        for run, raw in zip(runs, self._encode([" ".join(run) for run in runs])):
            stop = (self._width * (np.flatnonzero(self._ends[np.frombuffer(raw, self._kind)]) + 1)).tolist()
            if len(stop) == len(run):
                out += [raw[i:j] for i, j in zip([0, *stop], stop)]
            else:  # some word is more than one unit
                out += self._encode(run)
        return out

    def _lowered(self, text: str) -> str:
        if not self._lowers or any(m in text for m in self._marks):
            return text
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return text
        return text.lower()

    def _learn(self, words: list[str]) -> None:
        """Put the ids of ``words`` into the young generation."""
        young, old = self._young, self._old
        whole, made = [], []
        for w in words:
            v = old.get(w)
            if v is not None:
                young[w] = v
            elif (stem := w.rstrip(punctuation)) and len(stem) < len(w) and stem[-1].lower().isalnum() and not any(
                    m in w for m in self._marks):
                made.append((w, stem, w[len(stem):]))
            else:
                whole.append(w)
        stems = {p for _, a, b in made for p in (a, b)}.difference(young, whole)
        whole += [p for p in stems if (v := old.get(p)) is None or young.update({p: v})]
        letters = [w for w in whole if w.isalpha()]
        others = [w for w in whole if not w.isalpha()]
        young.update(zip(letters, self._encode_words(letters), strict=True))
        young.update(zip(others, self._encode(others), strict=True))
        young.update((w, young[a] + young[b]) for w, a, b in made)
        for _, stem, _ in made:
            if len(stem) > self._longest:
                self._long.add(stem)

    def of(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned ids of each text, ``width`` bytes each."""
        import pyarrow as pa
        import pyarrow.compute as pc

        if not self._by_word or not texts:
            return self._encode(texts)
        if len(self._young) > self._limit:
            self._old, self._young = self._young, {}
        parts = pc.split_pattern(pa.array([self._lowered(t).replace("\n", " ") for t in texts], pa.large_string()), " ")
        coded = parts.flatten().dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        self._young[""] = b""
        new = [w for w in words if w not in self._young]
        self._learn(new)
        ids = list(map(self._young.__getitem__, words))
        for w in self._long.union(w for w in new if len(w) > self._longest):
            self._young.pop(w, None)
        self._long.clear()
        return laid_out(ids, self._kind, coded.indices.to_numpy(), parts.offsets.to_numpy())


_MADE: dict[tuple, WordIds] = {}


def _word_ids(js: bytes, width: int) -> WordIds:
    """One per worker process, vocabulary and width."""
    key = hash(js), width
    if key not in _MADE:
        _MADE[key] = WordIds(js, width)
    return _MADE[key]


def _greatest_id(tokenizer_json: bytes) -> int:
    import json

    spec = json.loads(tokenizer_json)
    return max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])])


def write_ids(df: DataFrame, tokenizer: str, end_id: int, folder: str | None = None, id_col: str = "doc_id",
              text_col: str = "text", num_files: int | None = None, level: int = 3) -> tuple[DataFrame, str]:
    """Encode every text and write the id files; returns (index, folder).

    One shuffle: documents are range-partitioned by id (``num_files`` ranges, by
    default the number of shuffle partitions) and sorted inside each.
    """
    spark = df.sparkSession
    ship_package(spark)
    folder = folder or shared_path(spark, "id-frames")
    with open(tokenizer, "rb") as f:
        raw = f.read()
    js = spark.sparkContext.broadcast(raw)
    width = 2 if max(end_id, _greatest_id(raw)) < 1 << 16 else 4
    n = num_files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    rows = rows.repartitionByRange(n, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), "text")

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        task = TaskContext.get()
        part = task.partitionId()
        fs, base = open_folder(folder)
        name = f"ids-{part:06d}.zst"
        temp = f"{base}/_writing-{part:06d}-{task.taskAttemptId()}"
        words, end = _word_ids(js.value, width), end_id.to_bytes(width, "little")
        out, start = None, 0
        for b in batches:
            if not b.num_rows:
                continue
            if out is None:
                fs.create_dir(base, recursive=True)
                out = FrameWriter(fs.open_output_stream(temp), level)
            first, frames, starts, counts = [], [], [], []
            for texts in runs_of(b.column("text").to_pylist()):
                for ids in words.of(texts):
                    ids += end
                    nums = [out.add(ids[i:i + width * FRAME_IDS]) for i in range(0, len(ids), width * FRAME_IDS)]
                    first.append(nums[0])
                    frames.append(len(nums))
                    starts.append(start)
                    counts.append(len(ids) // width)
                    start += len(ids) // width
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([name] * b.num_rows), pa.array(first, pa.int64()),
                 pa.array(frames, pa.int32()), pa.array(starts, pa.int64()), pa.array(counts, pa.int64()),
                 pa.array([width] * b.num_rows, pa.int32())],
                names=["doc_id", "file", "first_frame", "n_frames", "start_in_file", "n_tokens", "width"])
        if out is not None:
            out.close()
            fs.move(temp, f"{base}/{name}")
        release_memory()

    return written(rows.mapInArrow(run, _INDEX), "id-frames-index"), folder


def with_starts(index: DataFrame, out: str = "start") -> DataFrame:
    """Index with ``out``: ids of all documents before, over all files in order.  The
    per-file totals (one row a file) are summed and joined back."""
    files = index.groupBy("file").agg(F.sum("n_tokens").alias("__n"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    return index.join(F.broadcast(files), "file").withColumn(
        out, F.col("__before") + F.col("start_in_file")).drop("__before")


def read_ids(index: DataFrame, folder: str, out: str = "ids") -> DataFrame:
    """The ids of the documents in ``index`` (any subset of an index), as a binary column
    ``out`` of little-endian unsigned 32-bit ids; every frame read is checked.
    Only the frames of these documents are read."""
    ship_package(index.sparkSession)
    names = [c for c in index.columns if c != out]

    def run(batches):
        import numpy as np
        import pyarrow as pa

        fs, base = open_folder(folder)
        at, reader = None, None
        for b in batches:
            cells = []
            where = (b.column(c).to_pylist() for c in ("file", "first_frame", "n_frames", "width"))
            for file, first, n, width in zip(*where, strict=True):
                if file != at:
                    at, reader = file, FrameReader(fs.open_input_file(f"{base}/{file}"))
                raw = b"".join(reader.frame(k) for k in range(first, first + n))
                cells.append(raw if width == 4 else np.frombuffer(raw, "<u2").astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(cells, pa.binary())],
                                             names=[*names, out])

    schema = index.select(*names).withColumn(out, F.lit(b"")).schema
    return index.select(*names).mapInArrow(run, schema)
