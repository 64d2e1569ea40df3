"""Sinks: marker text, JSON, bounded components, reproducible archives, hashes."""

from __future__ import annotations

import json
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

STAMP = (1980, 1, 1, 0, 0, 0)


def term_json(terms: DataFrame) -> Column:
    """A term row as one JSON array of eight fields; the glossary is JSON already."""
    s = lambda c: F.substring(F.to_json(F.array(c)), F.lit(2), F.length(F.to_json(F.array(c))) - 2)
    fields = [s(terms["expression"]), s(terms["reading"]), F.lit('""'), F.lit('""'), F.lit("0"), terms["glossary"], terms["sequence"].cast("string"), F.lit('""')]
    return F.concat(F.lit("["), F.concat_ws(",", *fields), F.lit("]"))


def banks(packed: DataFrame, order: str, payload: str) -> DataFrame:
    """(bank, text): each component's text; a component is bounded by its byte limit."""
    rows = F.transform(F.array_sort(F.collect_list(F.struct(order, payload))), lambda r: r[payload])
    return packed.groupBy("bank").agg(F.concat(F.lit("["), F.array_join(rows, ","), F.lit("]\n")).alias("text"))


def write_marker_text(lines: DataFrame, path: str) -> None:
    """(line_no, line) as text files in order (one per range of lines)."""
    lines.orderBy("line_no").select("line").write.mode("overwrite").text(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_report(report: dict, path: str, spark: SparkSession) -> None:
    """A small JSON file (totals, not rows) at a path of any file system that Spark knows."""
    jvm = spark.sparkContext._jvm  # the session's own file system classes
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(bytearray((json.dumps(report, ensure_ascii=False, indent=1, sort_keys=True) + "\n").encode()))
    finally:
        out.close()


def write_archive(components: DataFrame, index: dict, path: str) -> list[str]:
    """A ZIP with fixed stamps and order: equal input gives equal bytes. Returns the member names."""
    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    names = []
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED, compresslevel=9) as z:

        def put(name: str, text: str) -> None:
            info = zipfile.ZipInfo(name, STAMP)
            info.compress_type, info.external_attr, info.create_system = zipfile.ZIP_DEFLATED, 0o644 << 16, 3
            z.writestr(info, text.encode(), compresslevel=9)
            names.append(name)

        put("index.json", json.dumps(index, ensure_ascii=False, separators=(",", ":")) + "\n")
        for row in components.orderBy("bank").toLocalIterator():  # one component at a time
            put(f"term_bank_{row['bank']}.json", row["text"])
    with zipfile.ZipFile(target) as z:
        if (bad := z.testzip()) is not None:
            raise ValueError(f"{path}: member {bad} is damaged")
    return names


def check_archive(path: str, limit: int) -> int:
    """Reads every component back, one at a time; raises if one is no list of eight-field rows below the limit. The number of rows."""
    n = 0
    with zipfile.ZipFile(path) as z:
        for info in z.infolist():
            if not info.filename.startswith("term_bank_"):
                continue
            rows = json.loads(z.read(info))
            if info.file_size >= limit or not isinstance(rows, list) or any(not isinstance(r, list) or len(r) != 8 for r in rows):
                raise ValueError(f"{path}: {info.filename} is no valid component")
            n += len(rows)
    return n


def content_hash(text: Column, normalize_lines: bool = False) -> Column:
    text = F.replace(text, F.lit("\r\n"), F.lit("\n")) if normalize_lines else text
    return F.sha2(text, 256)
