"""Field and line parsing against Python's own csv, float and int."""

import csv
import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from lendwatch.functions import parsing
from lendwatch.schema import AMOUNT_COLUMNS, RAW_COLUMNS, TEXT_COLUMNS
from lendwatch.sources import raw_text


def apply(spark, texts, expression):
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "i int, t string").select("i", expression(F.col("t")).alias("v"))
    return [r.v for r in df.orderBy("i").collect()]


def python_amount(text):
    text = text.strip()
    if text.upper() in ("", "NA", "NULL", "-"):
        return 0.0
    try:
        value = float(text.replace(".", "").replace(",", "."))
    except ValueError:
        return None
    return value if math.isfinite(value) else None


def python_count(text):
    """The stored column holds 64 bits; a larger count is refused."""
    try:
        count = int(text or 0)
    except ValueError:
        return None
    return count if abs(count) < 2**63 else None


AMOUNTS = [
    "1.234.567,89", "", " ", "NA", "na", "null", "-", "1,2,3", "abc", "1d", "1f", "NaN", "inf",
    "Infinity", "+5", "-5,25", "1e5", "1,5E-3", "1_000", "_1", "1_", "1__0", ",5", "5,", ".", ",",
    "N.A", "N.A.", "..5", "\t7,5\n", " 12　", "--1", "- 1", "1 2", "1e999", "0x10", "1e", "e5",
    "9" * 400,
]


def test_amounts_like_python(spark):
    assert apply(spark, AMOUNTS, parsing.br_number) == [python_amount(t) for t in AMOUNTS]


def test_counts_like_python(spark):
    texts = ["", " ", "7", " 7 ", "-7", "+7", "1.234", "1_000", "1__0", "7.0", "x", "1e3", "1-2", "9" * 30]
    assert apply(spark, texts, parsing.operation_count) == [python_count(t) for t in texts]


@pytest.mark.parametrize("strict", [False, True])
def test_dates(spark, strict):
    expected = {
        "2025-01-31": dt.date(2025, 1, 31),
        " 2025-01-31\t": dt.date(2025, 1, 31),
        "2025-13-45": None,
        "2025-1-31": None,
        "31/01/2025": None,
        "": None,
        "202501": None if strict else dt.date(2025, 1, 1),
        "20250131": None if strict else dt.date(2025, 1, 31),
        "202513": None,
        "2025013": None,
    }
    got = apply(spark, list(expected), lambda t: parsing.reference_date(t, strict))
    assert got == list(expected.values())


def test_headers(spark):
    lines = ["data_base;uf", ' ﻿"DATA_BASE";x', '"data-base"', '"2025-01-31"', "", "x data_base"]
    assert apply(spark, lines, parsing.is_header) == [True, True, True, False, False, False]


def test_fields_like_python_csv(spark):
    rng = random.Random(7)
    lines = ["".join(rng.choice('ab;""; ') for _ in range(rng.randrange(1, 14))) for _ in range(3000)]
    lines = [line for line in lines if line.strip()]
    got = apply(spark, lines, parsing.split_fields)
    assert got == [next(csv.reader([line], delimiter=";")) for line in lines]


def test_short_lines_of_quotes_like_python_csv(spark):
    """Every line of up to six characters of quote, separator and letter, balanced as a file's fields are."""
    import itertools

    lines = ["".join(t) for n in range(1, 7) for t in itertools.product('";x', repeat=n)]
    want = [next(csv.reader([line], delimiter=";")) for line in lines]
    assert apply(spark, lines, parsing.split_fields) == want


def test_quoted_fields_are_cut_without_the_patterns(spark):
    """Only a line with a quote inside a field is searched field by field."""
    df = spark.createDataFrame([('"a";"b;c";""',), ('"";"x"',), ('"";""',)], "v string")
    fields = parsing.split_fields(F.col("v"))
    general = fields._jc.toString().upper().split("ELSE")[-1]
    assert "REGEXP_EXTRACT_ALL" in general and fields._jc.toString().upper().count("WHEN") == 2
    assert [r[0] for r in df.select(fields).collect()] == [["a", "b;c", ""], ["", "x"], ["", ""]]


def test_long_quoted_field_does_not_overflow(spark):
    line = '"' + 'x""' * 50_000 + '";y'
    assert apply(spark, [line], parsing.split_fields) == [['x"' * 50_000, "y"]]


def reference_row(line):
    """What one line gives, by Python's rules: a row, a reject, or nothing."""
    line = line.strip()
    bare = line.lstrip("﻿").lstrip('"').lower()
    if not line or bare.startswith(("data_base", "data-base")):
        return None
    fields = next(csv.reader([line], delimiter=";"))
    if len(fields) != len(RAW_COLUMNS):
        return "field_count"
    raw = dict(zip(RAW_COLUMNS, fields))
    date = raw["data_base"].strip()
    if len(date) in (6, 8) and date.isdigit():
        date = f"{date[:4]}-{date[4:6]}-{date[6:] or '01'}"
    try:
        date = dt.date.fromisoformat(date) if len(date) == 10 else None
    except ValueError:
        date = None
    amounts = [python_amount(raw[c]) for c in AMOUNT_COLUMNS]
    count = python_count(raw["numero_de_operacoes"])
    if date is None:
        return "bad_date"
    if count is None:
        return "bad_count"
    if None in amounts:
        return "bad_number"
    return (date, *[raw[c].strip() for c in TEXT_COLUMNS], count, *amounts)


def test_lines_like_python(spark):
    """Clean and damaged lines give the same rows by the short and the long way."""
    rng = random.Random(11)
    texts = ["PF", "", " a ", "Empréstimos", "x;y", 'say ""hi""', "é", " z", "–"]
    dates = ["2025-01-31"] * 8 + ["202501", "20250131", "2025-13-45", "", " 2025-01-31"]
    counts = ["12"] * 8 + ["", " ", "1.234", "+3", "1_0", "123456789012345678901"]
    amounts = ["1.234,56", "0,00", "0", "-7,5"] * 6 + AMOUNTS[:-1]
    clean = ["1.234,56", "0,00", "-1", "5,"]
    lines = []
    for i in range(1500):
        numbers = clean if i % 2 else amounts
        fields = [rng.choice(dates), *rng.choices(texts, k=9), rng.choice(counts)]
        fields += rng.choices(numbers, k=13)
        fields = [f.replace("\n", " ") for f in fields]
        quote = rng.random()
        if quote < 0.8:
            line = ";".join(f'"{f}"' for f in fields)
        else:
            line = ";".join(f if rng.random() < 0.5 else f'"{f}"' for f in fields)
        damage = rng.random()
        if damage < 0.05:
            line = line[:-3]
        elif damage < 0.1:
            line += ';"0"'
        elif damage < 0.15:
            line = line.replace('"', "", 1)
        lines.append(line)
    lines += ["", "  ", ";".join(RAW_COLUMNS), '﻿"data_base";"uf"']
    df = spark.createDataFrame([(line, "f") for line in lines], "value string, source_file string")
    good, quarantine = raw_text.parse_lines(df)
    expected = [reference_row(line) for line in lines]
    rejects = sorted((r.value, r.reason) for r in quarantine.collect())
    assert rejects == sorted((v, e) for v, e in zip(lines, expected) if isinstance(e, str))
    rows = sorted(map(str, (tuple(r)[:-1] for r in good.collect())))
    assert rows == sorted(str(e) for e in expected if isinstance(e, tuple))
