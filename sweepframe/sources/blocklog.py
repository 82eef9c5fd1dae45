"""``blocklog``: fixed-block result logs as a Spark data source (batch, stream, sink).

A block log is a sequence of equal-sized blocks; each block holds one
JSON record (UTF-8) padded with NUL bytes to the block size.  Block ``i``
starts at byte ``i * blockSize``.

Read side (``spark.read.format("blocklog")``) yields one row per block::

    path string, block_idx long, payload binary

``payload`` is the block with its NUL padding removed.  Input partitions
are block ranges of one file of about ``partitionBytes`` (128 MiB), lowered
so the log yields at least ``minPartitions`` tasks (pass the cluster's
default parallelism; ``blocksPerPartition`` overrides both), so a single
large log is read by many tasks in parallel.  A short final block is kept
(the batch reader takes what it finds), but the stream reader only
consumes whole blocks.  Indexed reads (``blocks``, ``minBlock``,
``maxBlock``, ``files`` options) plan only the partitions that hold the
requested blocks and seek straight to them.  ``scan_blocks`` gives the same
rows as a DataFrame whose filters on path and index are applied before a
block is read.

Write side (``df.write.format("blocklog")``) takes a ``value`` column
(string or binary): each value becomes one block.  A value longer than a
block fails the task.  Every task attempt writes files of its own name; the
job commit adds one manifest that lists the files of the attempts that won.
Readers of a folder with manifests see only what these list, so a killed job
or a retried or speculative task leaves the log unchanged.  With
``partitionBy`` the writer starts a new file (in ``<col>=<value>/``)
whenever the key changes; rows should be sorted by the key within each
partition.  With ``sizedBy`` the key is the block size of its file, so a log
of short and long records is not padded to the longest.  With ``compression``
``zstd`` a file holds its blocks in compressed frames (see ``_Packer``); it is
named ``*.zst.log``, and readers find block ``i`` behind ``i * blockSize`` bytes
of its unpacked content.  Readers take
``blockSize`` as a number, as ``auto`` (each file's stride is looked for in
its text) or as ``listed`` (what the manifests say).
"""

from __future__ import annotations

import json
import os
import posixpath
import struct
import uuid
from dataclasses import dataclass
from typing import Iterator, Tuple

import pyarrow as pa
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamArrowWriter,
    DataSourceStreamReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

# Fixed values shared with the log format: default block size (64 KiB) and
# the write buffer of 256 blocks (16 MiB).
DEFAULT_BLOCK_SIZE = 65536
WRITE_BUFFER_BLOCKS = 256

SCHEMA = StructType([
    StructField("path", StringType(), False),
    StructField("block_idx", LongType(), False),
    StructField("payload", BinaryType(), False),
])

_BATCH_ROWS = 512
_BATCH_BYTES = 32 * 1024 * 1024


# --------------------------------------------------------------------------
# file system access (local paths or any URI pyarrow understands)
# --------------------------------------------------------------------------

#: Hadoop schemes that pyarrow knows by another name.
_SCHEMES = {"s3a": "s3", "s3n": "s3"}


def _fs(path: str):
    """(filesystem, inner path, scheme) of a Hadoop path: ``/x``, ``file:/x``,
    ``file:///x`` and any URI whose store pyarrow can open."""
    from pyarrow import fs as pafs

    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/"), "file"
    if "://" in path:
        scheme, rest = path.split("://", 1)
        path = f"{_SCHEMES.get(scheme, scheme)}://{rest}"
        filesystem, inner = pafs.FileSystem.from_uri(path)
        scheme = path.split("://", 1)[0]
        return filesystem, inner, scheme
    return pafs.LocalFileSystem(), os.path.abspath(path), None


def _qualify(scheme, inner):
    if scheme is None:
        return inner
    if scheme == "file":
        return "file://" + inner
    return f"{scheme}://{inner}"


#: Folder of a log's manifests.
MANIFESTS = "_manifests"


@dataclass
class Manifest:
    """One commit of the sink: files (path below the log, size, block size); ``replaces`` hides all earlier ones.

    Names begin with a number, so their order is the order of commits.
    """

    name: str
    files: list
    replaces: bool = False


def manifest_names(filesystem, root: str) -> list[str]:
    """Names of a folder's manifests in the order of their commits; none for a plain folder."""
    from pyarrow import fs as pafs

    infos = filesystem.get_file_info(pafs.FileSelector(posixpath.join(root, MANIFESTS), allow_not_found=True))
    return sorted(f.base_name for f in infos if f.base_name.endswith(".json") and not f.base_name.startswith("."))


def read_manifest(filesystem, root: str, name: str) -> Manifest:
    with filesystem.open_input_stream(posixpath.join(root, MANIFESTS, name)) as f:
        body = json.loads(f.read())
    return Manifest(name, body["files"], body["replaces"])


def committed(filesystem, root: str) -> list[Manifest] | None:
    """The manifests that count, oldest first (the last one that replaces, and later ones); None for a plain folder."""
    names = manifest_names(filesystem, root)
    out: list[Manifest] = []
    for name in reversed(names):
        out.append(read_manifest(filesystem, root, name))
        if out[-1].replaces:
            break
    return out[::-1] if names else None


def add_manifest(filesystem, root: str, tag: str, files: list, replaces: bool = False) -> str:
    """Commit files: one hidden file, then one rename.  A manifest of the same tag is replaced in its place."""
    names = manifest_names(filesystem, root)
    same = [n for n in names if n.split("-", 1)[1] == f"{tag}.json"]
    number = int(names[-1].split("-", 1)[0]) + 1 if names else 0
    name = same[0] if same else f"{number:012d}-{tag}.json"
    folder = posixpath.join(root, MANIFESTS)
    filesystem.create_dir(folder, recursive=True)
    hidden = posixpath.join(folder, f".{name}.{uuid.uuid4().hex[:8]}")
    with filesystem.open_output_stream(hidden) as f:
        f.write(json.dumps({"files": files, "replaces": replaces}).encode())
    filesystem.move(hidden, posixpath.join(folder, name))
    return name


def list_log_files(path: str) -> list[tuple[str, int]]:
    """(path, size) of every log file under ``path``: what the manifests list, else all but hidden and ``_`` files."""
    return [(p, size) for p, size, _ in _listed(path)]


def _listed(path: str) -> list[tuple[str, int, int]]:
    """``list_log_files`` with the block size that a manifest gives, else 0."""
    from pyarrow import fs as pafs

    out = []
    for p in path.split(","):
        p = p.strip()
        if not p:
            continue
        filesystem, inner, scheme = _fs(p)
        info = filesystem.get_file_info(inner)
        if info.type == pafs.FileType.File:
            out.append((_qualify(scheme, inner), _length(filesystem, inner, info.size), 0))
        elif (commits := committed(filesystem, inner) if info.type == pafs.FileType.Directory else None) is not None:
            out += [(_qualify(scheme, posixpath.join(inner, name)), size, block) for m in commits for name, size, block in m.files]
        elif info.type == pafs.FileType.Directory:
            sel = pafs.FileSelector(inner, recursive=True)
            for f in filesystem.get_file_info(sel):
                rel = f.path[len(inner):]
                if f.type != pafs.FileType.File:
                    continue
                if any(seg.startswith((".", "_")) for seg in rel.split("/") if seg):
                    continue
                out.append((_qualify(scheme, f.path), _length(filesystem, f.path, f.size), 0))
        else:
            raise FileNotFoundError(p)
    out.sort()
    return out


def _open_read(path: str):
    filesystem, inner, _ = _fs(path)
    f = filesystem.open_input_file(inner)
    return _Packed(f, path) if inner.endswith(PACKED) else f


# --------------------------------------------------------------------------
# packed files
# --------------------------------------------------------------------------

#: End of a packed file's name, and bytes of whole blocks in a frame (one block at least).
PACKED, FRAME_BYTES = ".zst.log", 1 << 18
#: End of a packed file: bytes of a frame unpacked, bytes of all, number of frames, and a mark.
_END, _END_BYTES, _MARK = "<QQQ8s", 32, b"blocklgz"


class _Packer:
    """Writes zstd frames of equally many whole blocks each, then where every frame ends, then ``_END``."""

    def __init__(self, out, block: int):
        self.out, self.codec = out, pa.Codec("zstd")
        self.frame = max(1, FRAME_BYTES // block) * block
        self.held, self.length, self.ends = bytearray(), 0, [0]

    def write(self, data: bytes):
        self.held += data
        self.length += len(data)
        done = len(self.held) // self.frame * self.frame
        for at in range(0, done, self.frame):
            self._put(bytes(self.held[at:at + self.frame]))
        del self.held[:done]

    def _put(self, frame: bytes):
        packed = self.codec.compress(frame, asbytes=True)
        self.out.write(packed)
        self.ends.append(self.ends[-1] + len(packed))

    def close(self):
        if self.held:
            self._put(bytes(self.held))
        n = len(self.ends) - 1
        self.out.write(struct.pack(f"<{n}Q", *self.ends[1:]) + struct.pack(_END, self.frame, self.length, n, _MARK))
        self.out.close()


class _Packed:
    """A packed file read as its unpacked content; one frame is held at a time."""

    def __init__(self, f, path: str):
        self.f, size = f, f.size()
        end = f.read_at(_END_BYTES, size - _END_BYTES) if size >= _END_BYTES else b""
        if end[-len(_MARK):] != _MARK:
            f.close()
            raise ValueError(f"blocklog: {path} is not a whole packed file")
        self.frame, self.length, n, _ = struct.unpack(_END, end)
        self.ends = (0, *struct.unpack(f"<{n}Q", f.read_at(8 * n, size - _END_BYTES - 8 * n)))
        self.codec, self.pos, self.at, self.data = pa.Codec("zstd"), 0, None, b""

    def seek(self, pos: int):
        self.pos = pos

    def read(self, n: int) -> bytes:
        out = []
        while n > 0 and self.pos < self.length:
            k, skip = divmod(self.pos, self.frame)
            if k != self.at:
                packed = self.f.read_at(self.ends[k + 1] - self.ends[k], self.ends[k])
                size = min(self.frame, self.length - k * self.frame)
                self.data, self.at = self.codec.decompress(packed, decompressed_size=size, asbytes=True), k
            out.append(self.data[skip:skip + n])
            n -= len(out[-1])
            self.pos += len(out[-1])
        return b"".join(out)

    def close(self):
        self.f.close()

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.close()


def _length(filesystem, inner: str, size: int) -> int:
    """Bytes of a file's blocks: its size, or what a packed file says at its end."""
    if not inner.endswith(PACKED):
        return size
    with _Packed(filesystem.open_input_file(inner), inner) as f:
        return f.length


def unpacked_length(path, size):
    """Bytes of the blocks of log files, as a column; packed files (and no others) are opened by the tasks."""
    from pyspark.sql import functions as F

    @F.arrow_udf("long")
    def length(paths: pa.Array) -> pa.Array:
        def one(p):
            filesystem, inner, _ = _fs(p)
            return _length(filesystem, inner, 0)
        return pa.array([None if p is None or not p.endswith(PACKED) else one(p) for p in paths.to_pylist()], pa.int64())

    return F.coalesce(length(path), size)


# --------------------------------------------------------------------------
# block size detection
# --------------------------------------------------------------------------

def detect_block_size(path: str, window: int = 1 << 20) -> int:
    """Stride of a log file = byte offset of its second top-level JSON object.

    A JSON decoder finds where the first object ends; the next ``{`` starts
    block two.  The window doubles until both are in it, up to the whole
    file.  A file of one object has one block: its whole length.
    """
    files = list_log_files(path)
    return _stride(*files[0], window) if files else DEFAULT_BLOCK_SIZE


def _stride(path: str, size: int, window: int = 1 << 20) -> int:
    decoder = json.JSONDecoder(strict=False)
    with _open_read(path) as f:
        head = ""
        while len(head) < size:
            data = f.read(max(window, len(head)))
            if not data:
                break
            head += data.decode("latin-1")  # one character a byte, so offsets hold
            first = head.find("{")
            if first < 0:
                continue
            try:
                _, end = decoder.raw_decode(head, first)
            except ValueError:
                continue
            second = head.find("{", end)
            if second > 0:
                return second
    return max(size, 1)


def _whole_object(path: str, size: int) -> bool:
    """Whether a file that holds one object ends with it, padding apart."""
    with _open_read(path) as f:
        text = f.read(size).rstrip(b"\x00 \r\n\t").decode("utf-8", "replace")
    try:
        json.JSONDecoder(strict=False).raw_decode(text, max(0, text.find("{")))
    except ValueError:
        return False
    return True


def file_blocks(path: str, block: int | str = "auto") -> list[tuple[str, int, int]]:
    """(path, size, block size) of a log's files; ``listed`` sizes that no manifest gives are looked for."""
    def size_of(p, n, known):
        if block == "listed" and known:
            return known
        return _stride(p, n) if block in ("auto", "listed") else int(block)
    return [(p, n, size_of(p, n, known)) for p, n, known in _listed(path)]


def whole_blocks(path: str, block: int | str = "auto") -> int:
    """Whole blocks of all files of a log."""
    return sum(n // b for _, n, b in file_blocks(path, block))


# --------------------------------------------------------------------------
# indexed block selection
# --------------------------------------------------------------------------

@dataclass
class _Selection:
    lo: int = 0                 # inclusive
    hi: int | None = None       # exclusive
    idx: frozenset | None = None
    paths: frozenset | None = None

    def admits_range(self, a: int, b: int) -> tuple[int, int]:
        lo = max(a, self.lo)
        hi = b if self.hi is None else min(b, self.hi)
        return lo, hi

    def wanted(self, a: int, b: int) -> list[int] | None:
        """Explicit block list in [a, b) when an IN/= filter exists."""
        if self.idx is None:
            return None
        lo, hi = self.admits_range(a, b)
        return sorted(i for i in self.idx if lo <= i < hi)


def _selection_from_options(options) -> _Selection:
    """S4 indexed read: ``blocks`` (comma list), ``minBlock``/``maxBlock`` (inclusive),
    ``files`` (comma list of paths).  Stateless: fixed when the reader is made."""
    sel = _Selection()
    if options.get("blocks"):
        sel.idx = frozenset(int(x) for x in str(options["blocks"]).split(",") if x.strip())
    if options.get("minBlock") is not None:
        sel.lo = int(options["minBlock"])
    if options.get("maxBlock") is not None:
        sel.hi = int(options["maxBlock"]) + 1
    if options.get("files"):
        sel.paths = frozenset(x.strip() for x in str(options["files"]).split(",") if x.strip())
    return sel


class _BlockRange(InputPartition):
    def __init__(self, path: str, first: int, stop: int, block: int, blocks: list[int] | None = None):
        super().__init__((path, first, stop))
        self.path, self.first, self.stop, self.block, self.blocks = path, first, stop, block, blocks


def _read_range(part: _BlockRange, keep_padding: bool, whole_only: bool):
    block = part.block
    rows = max(1, min(_BATCH_ROWS, _BATCH_BYTES // block))  # a batch is bounded by rows and by bytes

    targets = part.blocks if part.blocks is not None else range(part.first, part.stop)
    paths, idxs, payloads = [], [], []
    with _open_read(part.path) as f:
        pos = None
        for i in targets:
            off = i * block
            if pos != off:
                f.seek(off)
            data = f.read(block)
            pos = off + len(data)
            if not data or (whole_only and len(data) < block):
                break
            if not keep_padding:
                data = data.rstrip(b"\x00")
            paths.append(part.path)
            idxs.append(i)
            payloads.append(data)
            if len(idxs) >= rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(paths, pa.string()), pa.array(idxs, pa.int64()),
                     pa.array(payloads, pa.binary())], names=SCHEMA.names)
                paths, idxs, payloads = [], [], []
    if idxs:
        yield pa.RecordBatch.from_arrays(
            [pa.array(paths, pa.string()), pa.array(idxs, pa.int64()),
             pa.array(payloads, pa.binary())], names=SCHEMA.names)


def _options(options) -> tuple[str, int | str, int, bool]:
    path = options.get("path") or options.get("paths")
    if not path:
        raise ValueError("blocklog: a path is required")
    if path.startswith("["):  # load([...]) passes a JSON list
        path = ",".join(json.loads(path))
    bs = str(options.get("blockSize", DEFAULT_BLOCK_SIZE))
    block = bs if bs in ("auto", "listed") else int(bs)
    per_part = int(options.get("blocksPerPartition", 0))  # 0: derive from partitionBytes
    keep = str(options.get("keepPadding", "false")).lower() == "true"
    return path, block, per_part, keep


class BlockLogReader(DataSourceReader):
    def __init__(self, options):
        self.path, block, self.per_part, self.keep = _options(options)
        self.block = block if isinstance(block, str) or block > 0 else DEFAULT_BLOCK_SIZE
        self.sel = _selection_from_options(options)
        self.part_bytes = int(options.get("partitionBytes", 128 * 1024 * 1024))
        self.min_parts = int(options.get("minPartitions", 8))

    def _blocks_per_partition(self, files: list[tuple[str, int, int]], block: int) -> int:
        """Explicit ``blocksPerPartition``, else ``partitionBytes`` (128 MiB) worth
        of blocks, lowered so the log gives at least ``minPartitions`` tasks."""
        if self.per_part > 0:
            return self.per_part
        total = sum(-(-size // b) for _, size, b in files)
        cap = max(1, self.part_bytes // block)
        floor_split = -(-total // max(1, self.min_parts)) if total else 1
        return max(1, min(cap, floor_split))

    def partitions(self):
        """Ranges of blocks; with ``auto`` and ``listed`` every file has a stride of its own."""
        parts = []
        files = file_blocks(self.path, self.block)
        for path, size, block in files:
            if self.sel.paths is not None and path not in self.sel.paths:
                continue
            per_part = self._blocks_per_partition(files, block)
            nblocks = -(-size // block)
            lo, hi = self.sel.admits_range(0, nblocks)
            for a in range(lo, hi, per_part):
                b = min(a + per_part, hi)
                wanted = self.sel.wanted(a, b)
                if wanted is not None and not wanted:
                    continue
                parts.append(_BlockRange(path, a, b, block, wanted))
        return parts or [_BlockRange("", 0, 0, DEFAULT_BLOCK_SIZE, [])]

    def read(self, partition):
        if not partition.path:
            return iter(())
        return _read_range(partition, self.keep, whole_only=False)


class BlockLogStreamReader(DataSourceStreamReader):
    """Tail of a growing log, whole blocks only.

    The offset of a folder with manifests is a cursor: the manifest being
    read, and the file and block inside it; it does not grow with the log.
    Files of a plain folder may all grow, so each has an entry of its own:
    blocks done, and the file's stride, which holds once it is found.

    ``maxBlocksPerBatch`` bounds a batch.  Spark does not tell a Python
    reader where a restarted query stands, so with a bound the end of every
    planned batch is kept in the file that option ``progress`` names, which
    belongs in the query's checkpoint folder.
    """

    def __init__(self, options):
        self.path, self.block, self.per_part, self.keep = _options(options)
        self.limit = int(options.get("maxBlocksPerBatch", 0))
        self.progress = options.get("progress")
        if self.limit and not self.progress:
            raise ValueError("blocklog: maxBlocksPerBatch needs a progress file")
        self.planned = self._recorded() if self.limit else None

    def _recorded(self):
        filesystem, inner, _ = _fs(self.progress)
        if not filesystem.get_file_info(inner).is_file:
            return None
        with filesystem.open_input_stream(inner) as f:
            return json.loads(f.read())

    def _record(self, end):
        filesystem, inner, _ = _fs(self.progress)
        filesystem.create_dir(posixpath.dirname(inner), recursive=True)
        hidden = f"{inner}.{uuid.uuid4().hex[:8]}"
        with filesystem.open_output_stream(hidden) as f:
            f.write(json.dumps(end).encode())
        filesystem.move(hidden, inner)

    def initialOffset(self):
        return {"commit": "", "file": 0, "block": 0, "files": {}}

    def latestOffset(self):
        start = self.planned or self.initialOffset()
        ranges, end = self._ahead(start, self.limit)
        return end

    def partitions(self, start, end):
        if self.limit:
            self.planned = end
            self._record(end)
        parts = []
        for path, lo, hi, block in self._between(start, end):
            per_part = self.per_part if self.per_part > 0 else max(1, (128 * 1024 * 1024) // block)
            parts += [_BlockRange(path, a, min(a + per_part, hi), block) for a in range(lo, hi, per_part)]
        return parts

    def read(self, partition):
        return _read_range(partition, self.keep, whole_only=True)

    def commit(self, end):
        pass

    def _logs(self):
        """(folder, its manifests' names) of folders with manifests, and the other files."""
        folders, plain = [], []
        for p in filter(None, (x.strip() for x in self.path.split(","))):
            filesystem, inner, scheme = _fs(p)
            names = manifest_names(filesystem, inner)
            if names:
                folders.append((filesystem, inner, scheme, names))
            else:
                plain += list_log_files(p)
        if len(folders) > 1:
            raise ValueError("blocklog: a stream reads one folder with manifests")
        return folders, sorted(plain)

    def _stride_of(self, path, size, known):
        """Stride of a plain file, or 0 while its first block is not whole."""
        if self.block not in ("auto", "listed"):
            return self.block
        if known:
            return known
        stride = _stride(path, size)
        return stride if stride < size or _whole_object(path, size) else 0

    def _ahead(self, start, limit):
        """New ranges ``(path, lo, hi, block)`` from an offset on, at most ``limit`` blocks, and the offset behind them."""
        ranges, left = [], limit or None
        end = {"commit": start["commit"], "file": start["file"], "block": start["block"], "files": dict(start["files"])}
        folders, plain = self._logs()

        def take(path, lo, hi, block):
            nonlocal left
            hi = hi if left is None else min(hi, lo + left)
            if hi > lo:
                ranges.append((path, lo, hi, block))
                left = left if left is None else left - (hi - lo)
            return max(lo, hi)

        for filesystem, root, scheme, names in folders:
            for name in names:
                if name < end["commit"] or left == 0:
                    continue
                if name != end["commit"]:
                    end.update(commit=name, file=0, block=0)
                files = read_manifest(filesystem, root, name).files
                while end["file"] < len(files) and left != 0:
                    rel, size, block = files[end["file"]]
                    end["block"] = take(_qualify(scheme, posixpath.join(root, rel)), end["block"], size // block, block)
                    if end["block"] >= size // block:
                        end.update(file=end["file"] + 1, block=0)
        for path, size in plain:
            done, known = end["files"].get(path, (0, 0))
            stride = self._stride_of(path, size, known)
            if stride and left != 0:
                done = take(path, done, size // stride, stride)
                if done:
                    end["files"][path] = [done, stride]
        return ranges, end

    def _between(self, start, end):
        """The ranges between two offsets, whatever has been added since."""
        ranges = []
        folders, _ = self._logs() if end["commit"] else ([], [])
        for filesystem, root, scheme, names in folders:
            for name in names:
                if start["commit"] <= name <= end["commit"]:
                    first = (start["file"], start["block"]) if name == start["commit"] else (0, 0)
                    files = read_manifest(filesystem, root, name).files
                    last = (end["file"], end["block"]) if name == end["commit"] else (len(files), 0)
                    for i in range(first[0], min(last[0] + 1, len(files))):
                        rel, size, block = files[i]
                        lo = first[1] if i == first[0] else 0
                        hi = last[1] if i == last[0] else size // block
                        if hi > lo:
                            ranges.append((_qualify(scheme, posixpath.join(root, rel)), lo, hi, block))
        for path, (upto, stride) in sorted(end["files"].items()):
            done, before = start["files"].get(path, (0, stride))
            if before != stride:
                raise ValueError(f"blocklog: the stride of {path} changed from {before} to {stride}")
            if upto > done:
                ranges.append((path, done, upto, stride))
        return ranges


# --------------------------------------------------------------------------
# sink
# --------------------------------------------------------------------------

@dataclass
class _Written(WriterCommitMessage):
    files: list  # (path below the log's folder, size, block size)


class BlockLogWriter(DataSourceArrowWriter):
    def __init__(self, options, overwrite: bool):
        self.path, block, _, _ = _options(options)
        self.block = DEFAULT_BLOCK_SIZE if isinstance(block, str) else block
        self.overwrite = overwrite
        self.sized_by = options.get("sizedBy")
        self.partition_col = self.sized_by or options.get("partitionBy")
        self.header = options.get("headerJson")
        packing = str(options.get("compression", "none")).lower()
        if packing not in ("none", "zstd"):
            raise ValueError(f"blocklog: unknown compression {packing}")
        self.packed = packing == "zstd"
        self.job = uuid.uuid4().hex[:8]
        self.prefix = "part"
        filesystem, inner, _ = _fs(self.path)
        filesystem.create_dir(inner, recursive=True)

    def _encode_header(self, block):
        if self.header is None:
            return None
        raw = self.header.encode("utf-8")
        if len(raw) > block:
            raise ValueError(f"blocklog: header of {len(raw)} bytes exceeds block size {block}")
        return raw.ljust(block, b"\x00")

    def write(self, iterator):
        from pyspark import TaskContext

        ctx = TaskContext.get()
        pid = ctx.partitionId() if ctx else 0
        attempt = f"{ctx.taskAttemptId()}" if ctx else uuid.uuid4().hex[:8]
        filesystem, root, _ = _fs(self.path)
        block = self.block
        written, cur_key, out, seq = [], object(), None, 0
        pending = []

        def flush():
            if pending and out is not None:
                out.write(b"".join(pending))
                written[-1][1] += len(pending) * block
                pending.clear()

        def open_file(key):
            nonlocal out, seq, block
            if self.sized_by:
                block = int(key)
            header = self._encode_header(block)
            sub = "" if key is None else f"{self.partition_col}={key}"
            filesystem.create_dir(posixpath.join(root, sub), recursive=True)
            name = posixpath.join(sub, f"{self.prefix}-{pid:05d}-{seq:03d}-{self.job}-{attempt}{PACKED if self.packed else '.log'}")
            seq += 1
            out = filesystem.open_output_stream(posixpath.join(root, name), buffer_size=WRITE_BUFFER_BLOCKS * block)
            out = _Packer(out, block) if self.packed else out
            written.append([name, 0, block])
            if header is not None:
                out.write(header)
                written[-1][1] += block

        try:
            for batch in iterator:
                values = batch.column(batch.schema.get_field_index("value")).to_pylist()
                keys = (batch.column(batch.schema.get_field_index(self.partition_col)).to_pylist()
                        if self.partition_col else None)
                for j, v in enumerate(values):
                    key = keys[j] if keys is not None else None
                    if out is None or key != cur_key:
                        flush()
                        if out is not None:
                            out.close()
                        open_file(key)
                        cur_key = key
                    if v is None:
                        raise ValueError("blocklog: null record")
                    raw = v.encode("utf-8") if isinstance(v, str) else bytes(v)
                    if len(raw) > block:
                        raise ValueError(
                            f"blocklog: record too big: length={len(raw)} blockSize={block}")
                    pending.append(raw.ljust(block, b"\x00"))
                    if len(pending) >= WRITE_BUFFER_BLOCKS:
                        flush()
            flush()
        finally:
            if out is not None:
                out.close()
        return _Written(written)

    def commit(self, messages):
        filesystem, root, _ = _fs(self.path)
        before = committed(filesystem, root) if self.overwrite else None
        plain = self._plain_files(filesystem, root) if before is None else []
        files = [f for m in messages for f in (m.files if m else [])]
        if plain and not self.overwrite:  # a folder from before manifests goes on with all its files
            add_manifest(filesystem, root, "plain", [[name, size, self.block] for name, size in plain])
        add_manifest(filesystem, root, self.job, files, self.overwrite)
        old = [name for m in before or [] for name, *_ in m.files] + ([name for name, _ in plain] if self.overwrite else [])
        for name in old:  # nobody sees these any more
            try:
                filesystem.delete_file(posixpath.join(root, name))
            except FileNotFoundError:
                pass
        with filesystem.open_output_stream(posixpath.join(root, "_SUCCESS")):
            pass

    def _plain_files(self, filesystem, root):
        """Log files of a folder that has no manifest yet, but for this job's own."""
        from pyarrow import fs as pafs

        if manifest_names(filesystem, root):
            return []
        found = filesystem.get_file_info(pafs.FileSelector(root, recursive=True))
        return [(f.path[len(root):].lstrip("/"), _length(filesystem, f.path, f.size)) for f in found if f.type == pafs.FileType.File and f.path.endswith(".log")
                and f"-{self.job}-" not in f.base_name and not any(x.startswith((".", "_")) for x in f.path[len(root):].split("/") if x)]

    def abort(self, messages):
        filesystem, root, _ = _fs(self.path)
        for m in messages:
            for name, *_ in (m.files if m else []):
                info = filesystem.get_file_info(posixpath.join(root, name))
                if info.is_file:
                    filesystem.delete_file(info.path)


class BlockLogStreamWriter(DataSourceStreamArrowWriter):
    """Streaming sink: each micro-batch adds one file per task and one manifest, tagged by batch.

    A batch replayed after a failure puts its manifest in the place of the
    one it may have left, so the log holds every record exactly once.
    Queries that write one log need names of their own (option ``writer``).
    """

    def __init__(self, options):
        self.tag = f"{options.get('writer', 'stream')}-batch"
        self.inner = BlockLogWriter(options, overwrite=False)
        self.inner.prefix = "batch"

    def write(self, iterator):
        return self.inner.write(iterator)

    def commit(self, messages, batchId):
        filesystem, root, _ = _fs(self.inner.path)
        add_manifest(filesystem, root, f"{self.tag}-{batchId:08d}", [f for m in messages for f in (m.files if m else [])])

    def abort(self, messages, batchId):
        self.inner.abort(messages)


def read_blocks(requests, block_size: int = DEFAULT_BLOCK_SIZE, keep_padding: bool = False):
    """S4 at scale: fetch the blocks named by a DataFrame of ``(path, block_idx)``.

    Requests are range-sorted by path and index, so a task opens few files,
    reads each forward, and a file with many requested blocks is shared by
    several tasks.  Payloads leave a task in batches of at most
    ``_BATCH_BYTES``.  A column ``block`` gives the block size of the request's
    file.  Returns ``path, block_idx, payload`` like the scan.
    """
    from pyspark.sql import functions as F

    def fetch(batches):
        cur, fh, held, size = None, None, [], 0

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array([h[0] for h in held], pa.string()), pa.array([h[1] for h in held], pa.int64()),
                 pa.array([h[2] for h in held], pa.binary())], names=SCHEMA.names)

        try:
            for batch in batches:
                for p, b, block in zip(*(c.to_pylist() for c in batch.columns)):
                    if p != cur:
                        if fh is not None:
                            fh.close()
                        fh, cur = _open_read(p), p
                    fh.seek(b * block)
                    data = fh.read(block)
                    if not data:
                        continue
                    held.append((p, b, data if keep_padding else data.rstrip(b"\x00")))
                    size += block
                    if len(held) >= _BATCH_ROWS or size + block > _BATCH_BYTES:
                        yield out()
                        held, size = [], 0
            if held:
                yield out()
        finally:
            if fh is not None:
                fh.close()

    block = F.coalesce(F.col("block"), F.lit(block_size)) if "block" in requests.columns else F.lit(block_size)
    req = requests.select(F.col("path").cast("string").alias("path"), F.col("block_idx").cast("long").alias("block_idx"),
                          block.cast("long").alias("block"))
    req = req.repartitionByRange("path", "block_idx").sortWithinPartitions("path", "block_idx")
    return req.mapInArrow(fetch, SCHEMA)


def block_ranges(path: str, block_size: int | str = DEFAULT_BLOCK_SIZE, done: dict | None = None,
                 whole: bool = False) -> list[tuple[str, int, int, int]]:
    """``(path, first, stop, block size)`` of a log's files; ``done`` gives blocks to skip, by path.

    With ``whole``, a short last block, which may still be written, is left out.
    """
    out = []
    for p, size, block in file_blocks(path, block_size):
        first, stop = int((done or {}).get(p, 0)), size // block if whole else -(-size // block)
        if stop > first:
            out.append((p, first, stop, block))
    return out


def scan_blocks(spark, path: str, block_size: int | str = DEFAULT_BLOCK_SIZE, ranges: list | None = None):
    """The log's blocks ``path, block_idx, payload``, read only where the query's filters ask for them.

    Paths and block numbers are generated from the files' sizes (or the
    given ``block_ranges``), and a block is read behind that, so Catalyst
    moves filters and semi-joins on ``path`` and ``block_idx`` below the
    read.  Each query has a plan of its own; with
    ``DataSourceReader.pushFilters`` all queries on one DataFrame would get
    what was pushed last.
    """
    from pyspark.sql import functions as F

    step = 128 * 1024 * 1024
    ranges = [(p, a, min(a + max(1, step // block), stop), block) for p, first, stop, block in
              (block_ranges(path, block_size) if ranges is None else ranges) for a in range(first, stop, max(1, step // block))]
    table = spark.createDataFrame(ranges, "path string, first long, stop long, block int")
    # a range is a task's work; short logs are cut finer
    pieces = max(1, -(-2 * spark.sparkContext.defaultParallelism // max(1, len(ranges))))
    size = F.greatest(F.lit(1), F.ceil((F.col("stop") - F.col("first")) / pieces)).cast("long")
    table = table.withColumn("size", size).withColumn("first", F.explode(F.expr("sequence(first, stop - 1, size)")))
    table = table.withColumn("stop", F.least(F.col("first") + F.col("size"), F.col("stop")))
    table = table.repartition(max(1, len(ranges) * pieces), "path", "first")
    idx = table.select("path", "block", F.explode(F.sequence("first", F.col("stop") - 1)).alias("block_idx"))

    @F.arrow_udf("array<binary>")
    def block_at(columns: Iterator[Tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        """The block as a list of one, or an empty one behind the end of its file."""
        now, f, pos = None, None, None
        for paths, numbers, blocks in columns:
            out = []
            for p, i, n in zip(paths.to_pylist(), numbers.to_pylist(), blocks.to_pylist()):
                if p != now:
                    if f is not None:
                        f.close()
                    now, f, pos = p, _open_read(p), 0
                if pos != i * n:
                    f.seek(i * n)
                data = f.read(n)
                pos = i * n + len(data)
                out.append([data.rstrip(b"\x00")] if data else [])
            yield pa.array(out, pa.list_(pa.binary()))
        if f is not None:
            f.close()

    # a generator, so that filters on the payload stay behind the read
    read = idx.select("path", "block_idx", F.explode(block_at("path", "block_idx", "block")).alias("payload"))
    return read


class BlockLogDataSource(DataSource):
    @classmethod
    def name(cls):
        return "blocklog"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return BlockLogReader(self.options)

    def streamReader(self, schema):
        return BlockLogStreamReader(self.options)

    def writer(self, schema, overwrite):
        return BlockLogWriter(self.options, overwrite)

    def streamWriter(self, schema, overwrite):
        return BlockLogStreamWriter(self.options)
