"""Writers in the formats that the tables come in (S10 to S14). Files are staged beside their place and then moved there."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphforge.functions.geometry import points_size
from glyphforge.functions.text import cell, jsonl_filename, strip
from glyphforge.sources import archives
from glyphforge.sources.scratch import ship


def _move_single(df: DataFrame, staged: str, path: str, head: bytes = b"") -> None:
    """Concatenate the staged part files, in order, into one file at path; replaces what is there."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    source, target = (jvm.org.apache.hadoop.fs.Path(p) for p in (staged, path))
    fs = target.getFileSystem(conf)
    part = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(part, True)
    try:
        if head:
            out.write(bytearray(head))
        names = sorted(s.getPath().toString() for s in source.getFileSystem(conf).listStatus(source) if s.getPath().getName().startswith("part-"))
        for name in names:
            stream = fs.open(jvm.org.apache.hadoop.fs.Path(name))
            jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, 1 << 16, False)
            stream.close()
    finally:
        out.close()
    _replace(spark, part, target)
    fs.delete(source, True)


def _replace(spark: SparkSession, part, target) -> None:
    """Rename over what is there, in one step: a crash leaves the old file or the new one."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    over = spark._sc._gateway.new_array(hadoop.Options.Rename, 1)
    over[0] = hadoop.Options.Rename.OVERWRITE
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    full = target.getFileSystem(conf).makeQualified(target)
    hadoop.FileContext.getFileContext(full.toUri(), conf).rename(part.getFileSystem(conf).makeQualified(part), full, over)


def csv_line(columns: list[str]) -> Column:
    """The cells of a row as one CSV line: quoted where they hold a quote, comma or line break."""

    def quoted(c: str) -> Column:
        s = cell(F.col(f"`{c}`"))
        return F.when(s.rlike('[",\r\n]'), F.concat(F.lit('"'), F.replace(s, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(s)

    return F.concat_ws(",", *map(quoted, columns))


def write_lines(df: DataFrame, path: str, line: Column, order: list[str], ending: str = "\n", head: str = "") -> None:
    """One text file with a line for each row, in order."""
    staged = f"{path}.{uuid.uuid4().hex}.parts"
    df.orderBy(*order).select(line.alias("value")).write.option("lineSep", ending).text(staged)
    _move_single(df, staged, path, head.encode("utf-8"))


def write_csv(df: DataFrame, path: str, order: list[str], columns: list[str] | None = None, bom: bool = True, ending: str = "\r\n") -> None:
    """Header, byte-order mark, one file. Input and output may be the same path."""
    columns = columns or [c for c in df.columns if c not in order or c != "_ord"]
    head = ",".join('"' + c.replace('"', '""') + '"' if any(x in c for x in '",\r\n') else c for c in columns)
    write_lines(df, path, csv_line(columns), order, ending, ("\ufeff" if bom else "") + head + ending)


def write_archives(df: DataFrame, path: str, member: Column, content: Column, overwrite: bool = True) -> None:
    """S16 the other way: a ZIP archive for each partition, in one folder; all of them appear when every task is done, or none."""
    ship(df.sparkSession)
    df.sparkSession.dataSource.register(archives.ArchiveSource)
    out = df.select(member.cast("string").alias("member"), content.cast("binary").alias("content"))
    out.write.format("zip_members").mode("overwrite" if overwrite else "append").save(path)


def label_lines(df: DataFrame, image_path: str = "image_path", label: str = "label", skip_blank: bool = True) -> DataFrame:
    """`line`, path and label with a tab between; rows with a blank path are left out on request. Other columns stay."""
    out = df.where(strip(cell(F.col(image_path))) != "") if skip_blank else df
    return out.withColumn("line", F.concat_ws("\t", cell(F.col(image_path)), cell(F.col(label))))


def label_json(path: Column, label: Column, points: Column) -> Column:
    """Filename, text, width and height as a JSON line; null where the points give no size."""
    size = points_size(points)
    return F.when(size.isNotNull(), F.to_json(F.struct(jsonl_filename(path).alias("filename"), label.alias("text"), size.width.alias("width"), size.height.alias("height"))))


