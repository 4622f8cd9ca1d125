"""Sinks: ordered texts, tab-separated rosters, JSON manifests, versions."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import shortened, wrapped


def promoted(spark: SparkSession, staged: str, path: str, backup: str | None = None) -> None:
    """Put a finished folder in the place of another by renaming; what was there goes to ``backup``, or is removed once the new one is in place.
    Readers see the old folder, for a moment none, then the new one, never a half-written one."""
    at = lambda p: spark._jvm.org.apache.hadoop.fs.Path(p)
    fs = at(path).getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(at(f"{staged}/_SUCCESS")):
        raise FileNotFoundError(f"{staged} isn't finished")
    kept = backup or f"{path.rstrip('/')}.before-{uuid.uuid4().hex}"
    old = fs.exists(at(path))
    if old and (fs.exists(at(kept)) or not fs.rename(at(path), at(kept))):
        raise OSError(f"can't keep {path} as {kept}")
    if not fs.rename(at(staged), at(path)):
        if old:
            fs.rename(at(kept), at(path))
        raise OSError(f"can't put {staged} in the place of {path}")
    if old and not backup:
        fs.delete(at(kept), True)


def _replaced(rows: DataFrame, path: str, write) -> None:
    staged = f"{path.rstrip('/')}.staged-{uuid.uuid4().hex}"
    write(rows.write, staged)
    promoted(rows.sparkSession, staged, path)


def transcripts(lines: DataFrame, path: str) -> None:
    """K1: one text per meeting (meeting, transcript), a folder for each; all of them replace the ones before at once (K2)."""
    _replaced(lines.select("meeting", F.col("transcript").alias("value")), path, lambda w, p: w.partitionBy("meeting").text(p))


def roster(rows: DataFrame, path: str) -> None:
    """K4: the roster as tab-separated values in order."""
    _replaced(rows, path, lambda w, p: w.option("sep", "\t").option("header", True).csv(p))


def manifest(rows: DataFrame, path: str) -> None:
    """K5: JSON, refusing a path that exists."""
    rows.write.mode("errorifexists").json(path)


def if_changed(new: DataFrame, path: str, key: str) -> bool:
    """K3: write a version only if its rows differ from the one at ``path``; says whether it did."""
    spark = new.sparkSession
    fields = [c for c in new.columns if c != key]
    digest = F.sum(F.xxhash64(key, *fields).cast("decimal(38,0)"))
    try:
        old = spark.read.parquet(path).agg(digest, F.count("*")).first()
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        old = None
    if old is not None and tuple(old) == tuple(new.agg(digest, F.count("*")).first()):
        return False
    _replaced(new, path, lambda w, p: w.parquet(p))
    return True


def markdown_table(columns: list[str]) -> Column:
    """K6: a row as a line of a Markdown table, bars in cells escaped."""
    cells = [F.regexp_replace(F.coalesce(F.col(c).cast("string"), F.lit("")), r"\|", r"\\|") for c in columns]
    return F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))


#: Per kind of picture: columns of boxes, their distance across and down, their width and height, and whether a line joins each with the next.
LAYOUTS = {"rollout-map": (4, 232, 120, 200, 96, True), "system-map": (3, 304, 96, 280, 72, False), "milestone-timeline": (1, 0, 84, 800, 68, True), "decision-map": (2, 456, 132, 424, 108, False)}


def _escaped(text: Column) -> Column:
    """Text as it may stand in XML."""
    for mark, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(mark), F.lit(name))
    return text


def svg_picture(kind: Column, title: Column, nodes: Column) -> Column:
    """K7: a picture of one of the four kinds in SVG: its title and a box for each node (id, label, detail, ref), laid out by the
    kind, joined by lines where their order means something; null for another kind."""

    def laid_out(columns: int, across: int, down: int, width: int, height: int, joined: bool) -> Column:
        x = lambda i: 32 + i % columns * across
        y = lambda i: 88 + F.floor(i / columns).cast("int") * down

        def box(n: Column, i: Column) -> Column:
            text = lambda css, dy, of: F.concat(F.lit(f'<text class="{css}" x="12" y="{dy}">'), _escaped(of), F.lit("</text>"))
            label = F.array_join(F.transform(wrapped(n["label"], width // 10), lambda line, k: F.concat(F.lit('<tspan x="48" dy="'), F.when(k == 0, "0").otherwise("18"), F.lit('">'), _escaped(line), F.lit("</tspan>"))), "")
            parts = [text("id", 22, n["id"]), F.concat(F.lit('<text class="label" x="48" y="22">'), label, F.lit("</text>")), text("detail", height - 26, shortened(F.coalesce(n["detail"], F.lit("")), 35)), text("detail", height - 10, F.coalesce(n["ref"], F.lit("")))]
            place = F.format_string('<g transform="translate(%d,%d)">', x(i), y(i))
            return F.concat(place, F.lit(f'<rect class="node" width="{width}" height="{height}" rx="8"/>'), *parts, F.lit("</g>"))

        def line(i: Column) -> Column:
            return F.format_string('<line class="line" x1="%d" y1="%d" x2="%d" y2="%d"/>', x(i) + width // 2, y(i) + height // 2, x(i + 1) + width // 2, y(i + 1) + height // 2)

        total = 88 + F.ceil(F.size(nodes) / columns).cast("int") * down + 16
        head = F.concat(F.format_string('<svg xmlns="http://www.w3.org/2000/svg" width="960" height="%d" viewBox="0 0 960 %d" role="img">', total, total), F.lit("<title>"), _escaped(title), F.lit('</title><text class="heading" x="32" y="42">'), _escaped(title), F.lit("</text>"))
        steps = F.when(F.size(nodes) > 1, F.sequence(F.lit(0), F.greatest(F.size(nodes) - 2, F.lit(0)))).otherwise(F.array().cast("array<int>"))
        lines = [F.array_join(F.transform(steps, line), "")] if joined else []
        return F.concat(head, *lines, F.array_join(F.transform(nodes, box), ""), F.lit("</svg>"))

    out = F.lit(None).cast("string")
    for name, layout in LAYOUTS.items():
        out = F.when(kind == name, laid_out(*layout)).otherwise(out)
    return out
