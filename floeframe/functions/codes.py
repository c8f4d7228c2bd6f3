"""Ice-chart codes: concentrations, classes of development and floe size, and their names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Code tables (fixed values).
CONCENTRATION = {0: 0, 1: 0, 2: 0, 55: 0, 10: 1, 20: 2, 30: 3, 40: 4, 50: 5, 60: 6, 70: 7, 80: 8, 90: 9, 91: 10, 92: 10}
DEVELOPMENT = {0: 0, 80: 0, 81: 1, 82: 1, 83: 2, 84: 2, 85: 2, 86: 4, 87: 3, 88: 3, 89: 3, 91: 4, 93: 4, 95: 5, 96: 5, 97: 5, 98: 255, 99: 255}
FLOE = {0: 0, 22: 255, 1: 255, 2: 1, 3: 2, 4: 3, 5: 4, 6: 5, 7: 5, 8: 255, 9: 6, 10: 6, 21: 255}
DEVELOPMENT_NAMES = {0: "Open water", 1: "New Ice", 2: "Young ice", 3: "Thin FYI", 4: "Thick FYI", 5: "Old ice"}
FLOE_NAMES = {0: "Open water", 1: "Cake Ice", 2: "Small floe", 3: "Medium floe", 4: "Big floe", 5: "Vast floe", 6: "Bergs"}
NOT_FILLED, MASK, UNKNOWN, DOMINANT = -9, 255, 99, 65


def looked_up(code: Column, table: dict, cast: str = "int") -> Column:
    """The code's entry, or null."""
    # as text, because each literal made by itself would be a call of its own into the JVM
    pairs = F.expr(f"map({', '.join(f'{k}, CAST({v!r} AS {cast})' for k, v in table.items())})")
    return F.try_element_at(pairs, code)


def recoded(code: Column, table: dict) -> Column:
    """The code's class; codes that the table lacks stay as they are."""
    return F.coalesce(looked_up(code, table), code)


def tenths(code: Column) -> Column:
    """Tenths of ice of a total-concentration code; of a range, the mean of what its ends mean; else null."""
    trimmed = F.trim(code)
    number = lambda text: looked_up(text.try_cast("double").try_cast("int"), CONCENTRATION, "double")
    at = F.locate("-", F.substr(trimmed, F.lit(2)))
    low, high = F.substr(trimmed, F.lit(1), at), F.substr(trimmed, at + 2)
    return F.when(trimmed == str(NOT_FILLED), None).when(at > 0, (number(low) + number(high)) / 2).otherwise(number(trimmed))


def tenths_of(code: str) -> float | None:
    """`tenths` of one code, for tables that a task reads itself."""

    def number(text: str) -> float | None:
        try:
            return CONCENTRATION.get(int(float(text)))
        except (ValueError, OverflowError):
            return None

    code = code.strip(" ")
    if code == str(NOT_FILLED):
        return None
    if "-" not in code[1:]:
        return number(code)
    at = code.index("-", 1)
    ends = number(code[:at]), number(code[at + 1 :])
    return None if None in ends else sum(ends) / 2


def field(header: Column, row: Column, name: str) -> Column:
    """The `;`-separated row's field of that name in the header; null where either lacks it."""
    place = F.array_position(F.split(header, ";"), name)
    return F.when(place > 0, F.get(F.split(row, ";"), (place - 1).cast("int")))


def partial_filled(total: Column, first: Column) -> Column:
    """The first partial concentration, taken from the total where only that is given."""
    return F.when((total > 0) & (first == NOT_FILLED), total).otherwise(first)


def merged(classes: list[Column], parts: list[Column], how: str = "assign") -> list[Column]:
    """Partial concentrations with those of equal classes joined: A with B, A with C, B with C.

    assign: where A equals both B and C, C's is what is added; sum: both are.
    """
    a, b, c = classes
    same = lambda x, y: (x == y) & (x != NOT_FILLED)
    if how == "assign":
        add_a = F.when(same(a, c), parts[2]).when(same(a, b), parts[1]).otherwise(0)
    else:
        add_a = F.when(same(a, b), parts[1]).otherwise(0) + F.when(same(a, c), parts[2]).otherwise(0)
    return [parts[0] + add_a, parts[1] + F.when(same(b, c), parts[2]).otherwise(0), parts[2]]


def dominant(classes: list[Column], parts: list[Column], total: Column, most: Column | None = None) -> Column:
    """The class of the largest part if that has DOMINANT percent of the total, else NOT_FILLED; the first of equals.

    most: the largest part, where it is at hand."""
    most = F.greatest(*parts) if most is None else most
    which = F.array_position(F.array(*parts), most).cast("int")
    enough = F.when(total == 0, most > 0).otherwise(F.try_divide(most * 100, total) >= DOMINANT)
    return F.when(enough, F.get(F.array(*classes), which - 1)).otherwise(NOT_FILLED)


def with_polygon_classes(rows: DataFrame, total: str, parts: list[str], development: list[str], floe: list[str], kind: str, how: str = "assign") -> DataFrame:
    """rows with SIC, SOD and FLOE of a polygon from its recoded fields; overrides in the order in which they apply.

    Step by step, so that each number is computed once: as one expression the steps would repeat each other.
    """
    total, parts = F.col(total), [F.col(c) for c in parts]
    made, ends = rows, {}
    for out, names in (("sod", development), ("floe", floe)):
        classes = [F.col(c) for c in names]
        sums = [f"__{out}{k}" for k in range(3)]
        made = made.withColumns(dict(zip(sums, merged(classes, parts, how))))
        made = made.withColumn(f"__{out}most", F.greatest(*sums))
        made = made.withColumn(f"__{out}", dominant(classes, [F.col(c) for c in sums], total, F.col(f"__{out}most")))
        ends[out] = F.col(f"__{out}")
    ends["floe"] = F.when(F.array_contains(F.array(*floe), MASK), MASK).otherwise(ends["floe"])
    made = made.withColumns({"__sic": F.when(F.lower(kind) == "w", 0).otherwise(total)} | {f"__{c}": x for c, x in ends.items()})
    final = lambda x: F.when(F.col("__sic") == 0, 0).when(x.isin(NOT_FILLED, UNKNOWN), MASK).otherwise(x)
    sic = F.when(F.col("__sic") == UNKNOWN, MASK).otherwise(F.col("__sic"))
    classes = {"sic": sic} | {c: final(F.col(f"__{c}")) for c in ("sod", "floe")}
    made = made.withColumns({c: x.cast("int") for c, x in classes.items()})
    return made.drop(*(c for c in made.columns if c.startswith("__")))


def sic_name(k: Column) -> Column:
    return F.when(k.between(0, 10), F.concat((k * 10).cast("string"), F.lit("%")))
