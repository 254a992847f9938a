"""Allow and block rules for URLs in a sorted array of digests.

The rules are built once into one file: the ascending 64-bit digests of
``host + path``, the verdicts, and the strings themselves.  Spark brings the
file to every executor, where the workers map it into memory.  For a batch of
URLs all strings that could be a rule (each suffix of the host's labels with
each length of path that rules have) are hashed, found by one binary search over
the array, and confirmed against the stored strings.  The longest rule wins.

The host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end,
with A-Z in lower case; the path is what then follows up to ``?``, ``#`` or the
end.  For a null URL or one without ``://`` both are empty and no rule fits.
Repeated rows give repeated rows; a URL without a rule gets the default.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession

from quadloom.llm.common import by_batch, column, prepare
from quadloom.session import shared_folder

_URL = re.compile(r"://([^/?#]*)([^?#]*)", re.S)
_UPPER = {c: c + 32 for c in range(65, 91)}
_open: dict[str, "Rules"] = {}


def parts(url: str | None) -> tuple[str, str]:
    found = _URL.search(url) if url else None
    return (found[1].translate(_UPPER), found[2]) if found else ("", "")


def build(rules: Iterable[tuple[str, str, str]]) -> bytes:
    """The file for rules (verdict, host, path); a path begins with ``/``, and of equal rules the last counts."""
    verdicts = {}
    for verdict, host, path in rules:
        if verdict not in ("allow", "block") or not path.startswith("/") or "/" in host:
            raise ValueError(f"not a rule: {verdict} {host} {path}")
        verdicts[host.translate(_UPPER) + path] = verdict == "block"
    keys = sorted((xxhash.xxh64_intdigest(k.encode()), k.encode(), v) for k, v in verdicts.items())
    texts = [k for _, k, _ in keys]
    ends = np.cumsum([0, *map(len, texts)]).astype("<u8")
    head = np.array([len(keys)], "<u8").tobytes()
    digests = np.array([d for d, _, _ in keys], "<u8").tobytes()
    return b"".join([head, digests, ends.tobytes(), *texts, bytes(v for _, _, v in keys)])


class Rules:
    """A file of ``build``, mapped into memory."""

    def __init__(self, path: str):
        raw = np.memmap(path, np.uint8, "r")
        n = int(raw[:8].view("<u8")[0])
        self.digests = raw[8 : 8 + 8 * n].view("<u8")
        self.ends = raw[8 + 8 * n : 16 + 16 * n].view("<u8")
        text = 16 + 16 * n
        self.texts = raw[text : text + int(self.ends[-1])]
        self.blocks = raw[text + int(self.ends[-1]) :]
        # the lengths of path that any rule has
        slashes = [int(np.argmax(self.texts[a:b] == 47)) for a, b in zip(self.ends[:-1].tolist(), self.ends[1:].tolist())]
        ends = [bytes(self.texts[a + s : b]).decode() for a, b, s in zip(self.ends[:-1].tolist(), self.ends[1:].tolist(), slashes)]
        self.lengths = sorted({len(x) for x in ends}, reverse=True)

    def judge(self, urls: list[tuple[str, str]]) -> list[tuple[str, bool] | None]:
        """For each host and path the longest rule that fits, and whether it blocks."""
        rows, keys = [], []
        for row, (host, path) in enumerate(urls):
            at = 0
            while host and path:
                keys += [host[at:] + path[:k] for k in self.lengths if k <= len(path)]
                rows += [row] * (len(keys) - len(rows))
                at = host.find(".", at) + 1
                if not at:
                    break
        out: list[tuple[str, bool] | None] = [None] * len(urls)
        probes = np.array([xxhash.xxh64_intdigest(k.encode()) for k in keys], np.uint64)
        at = np.searchsorted(self.digests, probes)
        left = np.arange(len(keys))
        while len(left):  # more than once only where several rules have one digest
            left = left[at[left] < len(self.digests)]
            left = left[self.digests[at[left]] == probes[left]]
            for k in left.tolist():
                i = int(at[k])
                if bytes(self.texts[int(self.ends[i]) : int(self.ends[i + 1])]).decode() == keys[k]:
                    best = out[rows[k]]
                    if best is None or len(keys[k]) > len(best[0]):
                        out[rows[k]] = (keys[k], bool(self.blocks[i]))
            at[left] += 1
        return out


def install(spark: SparkSession, data: bytes) -> str:
    """Put the file into the shared folder and have Spark bring it to every executor; returns its name."""
    name = f"quadloom-rules-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/{name}")
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    out.write(bytearray(data))
    out.close()
    spark.sparkContext.addFile(path.toString())
    return name


def judge_urls(pages: DataFrame, rules: Iterable[tuple[str, str, str]], id_column: str = "page_id", url_column: str = "url", default: str = "allow") -> DataFrame:
    """``id_column``, host, path, rule (null: none) and verdict for every row."""
    name = install(prepare(pages.sparkSession), build(rules))

    def work(batch):
        if name not in _open:
            _open[name] = Rules(SparkFiles.get(name))
        urls = [parts(u) for u in column(batch, "url").to_pylist()]
        found = _open[name].judge(urls)
        return {
            id_column: column(batch, "id"),
            "host": pa.array([h for h, _ in urls], pa.string()),
            "path": pa.array([p for _, p in urls], pa.string()),
            "rule": pa.array([f and f[0] for f in found], pa.string()),
            "verdict": pa.array([default if f is None else "block" if f[1] else "allow" for f in found], pa.string()),
        }

    given = pages.selectExpr(f"`{id_column}` as id", f"cast(`{url_column}` as string) as url")
    kind = given.schema["id"].dataType.simpleString()
    return given.mapInArrow(by_batch(work), f"`{id_column}` {kind}, host string, path string, rule string, verdict string")
