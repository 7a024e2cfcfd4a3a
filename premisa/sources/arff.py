"""ARFF files as typed tables.  The header gives the schema; the body is parsed by Spark's CSV expression."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ATTRIBUTE = re.compile(r"^@attribute\s+(?:'(?P<q1>[^']*)'|\"(?P<q2>[^\"]*)\"|(?P<plain>\S+))\s+(?P<type>.+?)\s*$", re.I)
_VALUE = re.compile(r"\s*(?:'[^']*'|\"[^\"]*\"|[^,'\"]+)")
# The numeric type names of the format.
_NUMERIC = ("numeric", "real", "integer")
_CHARSETS = {"utf8": "utf-8", "latin1": "iso-8859-1", "latin-1": "iso-8859-1", "ascii": "us-ascii"}


def parse_header(lines: list[str]) -> T.StructType:
    """Schema from header lines; the domain of a nominal column goes to its metadata."""
    fields = []
    for line in lines:
        m = _ATTRIBUTE.match(line.strip())
        if not m:
            continue
        name = next(g for g in (m["q1"], m["q2"], m["plain"]) if g is not None)
        kind = m["type"].strip()
        if kind.startswith("{"):
            values = [v.strip().strip("'\"") for v in _VALUE.findall(kind.strip("{} "))]
            fields.append(T.StructField(name, T.StringType(), True, {"domain": values}))
        elif kind.lower() in _NUMERIC:
            fields.append(T.StructField(name, T.DoubleType()))
        else:
            fields.append(T.StructField(name, T.StringType()))
    return T.StructType(fields)


def _lines(spark: SparkSession, path: str, encoding: str) -> DataFrame:
    """The text source keeps a line's bytes as they are; other encodings than UTF-8 are decoded here."""
    lines = spark.read.text(path)
    charset = _CHARSETS.get(encoding.lower(), encoding)
    return lines if charset.lower() == "utf-8" else lines.select(F.decode(F.col("value").cast("binary"), charset).alias("value"))


def _header_lines(spark: SparkSession, path: str, encoding: str) -> list[str]:
    """The lines up to @data, read from the start of the first file that is not empty."""
    for first in sorted(spark.read.text(path).inputFiles()):
        lines, take = _lines(spark, first, encoding), 1_000
        while True:
            head = [r[0] for r in lines.take(take)]
            for i, line in enumerate(head):
                if line.strip().lower().startswith("@data"):
                    return head[:i]
            if len(head) < take:
                break
            take *= 10
        if head:
            break
    raise ValueError(f"no @data line at the start of {path}")


def _cells(line: Column, schema: T.StructType, quote: str) -> Column:
    return F.from_csv(
        line,
        schema.simpleString()[len("struct<"):-1].replace(":", " "),
        {"nullValue": "?", "quote": quote, "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"},
    )


def arff_scan(spark: SparkSession, path: str, encoding: str = "utf-8", header: str | None = None) -> DataFrame:
    """One file, or a directory whose first file (or the file ``header``) has the header; '?' reads as null."""
    head = _header_lines(spark, header or path, encoding)
    schema = parse_header(head)
    plain = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(schema)])
    line = F.trim("value")
    # A percent sign begins a comment anywhere; an at sign does not, but for the lines of a header.
    header_line = line.rlike(r"(?i)^@(relation|attribute)\s|^@data\s*$") | line.startswith("%")
    body = _lines(spark, path, encoding).where(~header_line & (line != ""))
    # A row with a double-quoted cell is read with double quotes, its single-quoted cells turned into such.
    double = line.rlike(r'(^|,)\s*"')
    turned = F.regexp_replace(line, r"""(^|,)\s*'([^'"]*)'\s*(?=,|$)""", '$1"$2"')
    row = F.when(double, _cells(turned, plain, '"')).otherwise(_cells(line, plain, "'"))
    return body.select(row.alias("r")).select(
        *[F.col(f"r.c{i}").alias(f.name, metadata=f.metadata) for i, f in enumerate(schema)]
    )
