"""Numbers of any length, compared by their digits, and arithmetic that keeps 28 of them at least.

A *number* is a struct (sign, place, digits): the digits without zeros at either end, and the
place of the point before which they stand, so that its value is ``sign * 0.digits * 10^place``.
Numbers compare by sign, then place, then digits as text, however long they are.

An *operand* is a pair of columns (u, s) of value ``u / 10^s`` with up to 38 digits in ``u``. Sums and
products are exact as long as 38 digits hold them; beyond that the last digits are cut off.
Quotients have 28 digits or more.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Text of a number. The exponent has at most 18 digits, as a place must fit into a long.
NUMBER_TEXT = r"^[+-]?(?:[0-9]+[.]?[0-9]*|[.][0-9]+)(?:[eE][+-]?[0-9]{1,18})?$"
WHOLE = "decimal(38,0)"
MOST = 38
#: Digits of a limb, and zeros that plain notation writes out.
LIMB, FAR = 6, 5000


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """What ``use`` makes of a value that is worked out once, however often ``use`` names it.

    Spark writes an expression out at every place that names it, and a filter from above along with
    all it is made of. Long ones make methods beyond 8000 bytes, which the JVM does not compile. The body
    of a lambda stands for itself: it is neither unfolded nor fused with the stage around it.
    """
    return F.transform(F.array(value), use)[0]


def number(text: Column) -> Column:
    """The number that stripped text holds, NULL where it is none."""
    def from_low(low: Column, exponent: Column) -> Column:
        return once(F.ltrim(F.substring_index(low, "e", 1), F.lit("+-")), lambda mantissa: once(
            F.replace(mantissa, F.lit("."), F.lit("")), lambda every: once(
                F.ltrim(every, F.lit("0")), lambda after_zeros: once(
                    F.rtrim(after_zeros, F.lit("0")), lambda digits: F.struct(
                        F.when(digits == "", 0).when(low.startswith("-"), -1).otherwise(1).alias("sign"),
                        F.when(digits == "", 0).otherwise(
                            F.length(F.substring_index(mantissa, ".", 1)) - (F.length(every) - F.length(after_zeros)) + exponent
                        ).cast("bigint").alias("place"),
                        digits.alias("digits"),
                    )))))

    def read(whole: Column) -> Column:
        exponent = F.coalesce(F.when(F.contains(whole, F.lit("e")), F.substring_index(whole, "e", -1).try_cast("bigint")), F.lit(0))
        return F.when(whole.rlike(NUMBER_TEXT), from_low(whole, exponent))

    return once(F.lower(text), read)


def literal(value: object) -> Column:
    """The number of a Python value, read from its text."""
    sign, digits, exponent = Decimal(str(value)).as_tuple()
    text = "".join(map(str, digits)).lstrip("0")
    place = len(text) + exponent if text else 0
    parts = {"sign": (-1 if sign else 1) if text else 0, "place": place, "digits": text.rstrip("0")}
    kinds = {"sign": "int", "place": "bigint", "digits": "string"}
    return F.struct(*[F.lit(part).cast(kinds[name]).alias(name) for name, part in parts.items()])


def below(a: Column, b: Column) -> Column:
    """Whether number ``a`` is smaller than number ``b``."""
    def nearer(x: Column, y: Column) -> Column:
        return (x["place"] < y["place"]) | ((x["place"] == y["place"]) & (x["digits"] < y["digits"]))

    return F.when(a["sign"] != b["sign"], a["sign"] < b["sign"]).when(a["sign"] < 0, nearer(b, a)).otherwise((a["sign"] > 0) & nearer(a, b))


def is_whole(x: Column) -> Column:
    return F.length(x["digits"]) <= x["place"]


def as_text(x: Column) -> Column:
    """Text that casts to double or decimal read."""
    return F.concat(F.when(x["sign"] < 0, "-").otherwise(""), F.lit("0."), x["digits"], F.lit("0E"), x["place"].cast("string"))


def plain_text(x: Column) -> Column:
    """All digits of a number in plain notation, or an exponent where thousands of zeros would stand."""
    size, place = F.length(x["digits"]), x["place"]
    near = F.greatest(F.least(place, F.lit(FAR)), F.lit(-FAR)).cast("int")
    split = F.concat(F.left(x["digits"], near), F.lit("."), F.substring(x["digits"], near + 1, size))
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), F.greatest(-near, F.lit(0))), x["digits"])
    plain = F.when(place <= 0, small).when(size <= place, F.rpad(x["digits"], near, "0")).otherwise(split)
    signed = F.concat(F.when(x["sign"] < 0, "-").otherwise(""), plain)
    return F.when(x["sign"] == 0, "0").when(F.abs(place) > FAR, as_text(x)).otherwise(signed)


def limbs(x: Column) -> Column:
    """A number cut into groups of six digits, as an array of (part, amount): it is the sum of ``amount * 10^(6 * part)``.

    Amounts have the sign of the number, so that sums by part over any rows keep its value. At least one part.
    """
    fraction = F.pmod(x["place"] - F.length(x["digits"]), F.lit(LIMB)).cast("int")
    padded = F.concat(x["digits"], F.repeat(F.lit("0"), fraction))
    count = F.greatest(F.ceil(F.length(padded) / LIMB), F.lit(1)).cast("int")
    lowest = F.floor((x["place"] - F.length(x["digits"])) / LIMB).cast("bigint")
    full = F.lpad(padded, count * LIMB, "0")

    def piece(i: Column) -> Column:
        amount = F.substring(full, (count - 1 - i) * LIMB + 1, F.lit(LIMB)).cast("bigint") * x["sign"]
        return F.struct(F.when(x["sign"] == 0, F.lit(0)).otherwise(lowest + i).cast("bigint").alias("part"), amount.alias("amount"))

    return F.transform(F.sequence(F.lit(0), count - 1), piece)


def from_limbs(parts: Column) -> Column:
    """The number that an array of summed limbs (part, amount), each part once, makes; zero of an empty one."""
    amounts = F.map_from_entries(parts)
    low, high = F.coalesce(F.array_min(F.map_keys(amounts)), F.lit(0)), F.coalesce(F.array_max(F.map_keys(amounts)), F.lit(0))
    base = 10**LIMB

    def carried(sign: int) -> Column:
        def step(state: Column, part: Column) -> Column:
            total = F.coalesce(F.try_element_at(amounts, part), F.lit(0).cast("bigint")) * sign + state["carry"]
            rest = F.pmod(total, F.lit(base).cast("bigint"))
            return F.struct(((total - rest) / base).cast("bigint").alias("carry"), F.concat(F.lpad(rest.cast("string"), LIMB, "0"), state["text"]).alias("text"))

        # A sum of longs reaches at most four limbs further up.
        return F.aggregate(F.sequence(low, high + 4), F.struct(F.lit(0).cast("bigint").alias("carry"), F.lit("").alias("text")), step)

    up, down = carried(1), carried(-1)
    text = F.when(up["carry"] < 0, down["text"]).otherwise(up["text"])
    after_zeros = F.ltrim(text, F.lit("0"))
    digits = F.rtrim(after_zeros, F.lit("0"))
    sign = F.when(digits == "", 0).when(up["carry"] < 0, -1).otherwise(1)
    place = F.when(digits == "", 0).otherwise(F.length(after_zeros) + low * LIMB).cast("bigint")
    return F.struct(sign.alias("sign"), place.alias("place"), digits.alias("digits"))


def half_even(x: Column, decimals: int) -> Column:
    """The number in units of its last decimal, ties to even, as a whole decimal; NULL beyond 38 digits."""
    def cut(y: Column) -> Column:
        at = F.greatest(F.least(y["at"], F.lit(MOST + 1)), F.lit(0)).cast("int")
        kept = F.substring(y["digits"], F.lit(1), at)
        return F.struct(
            y["sign"].alias("sign"), y["at"].alias("at"), kept.alias("kept"),
            F.when(y["at"] < 0, "").otherwise(F.substring(y["digits"], at + 1, F.length(y["digits"]))).alias("rest"),
            F.when(y["at"] <= 0, F.lit(0).cast(WHOLE)).otherwise(F.rpad(kept, at, "0").try_cast(WHOLE)).alias("units"),
        )

    def rounded(y: Column) -> Column:
        odd = F.substring(y["kept"], -1, 1).isin("1", "3", "5", "7", "9") & (F.length(y["kept"]) == y["at"])
        up = F.when((y["rest"] > "5") | ((y["rest"] == "5") & odd), 1).otherwise(0).cast(WHOLE)
        return once(F.try_add(y["units"], up), lambda size: F.when(y["sign"] < 0, _minus(size)).otherwise(size).cast(WHOLE))

    parts = F.struct(x["sign"].alias("sign"), (x["place"] + decimals).alias("at"), x["digits"].alias("digits"))
    return once(parts, lambda y: once(cut(y), rounded))


# ---- operands -------------------------------------------------------------------

def _minus(u: Column) -> Column:
    """Spark's own sign change and absolute value round to 34 digits."""
    return F.try_subtract(F.lit(0).cast(WHOLE), u)


def _text(u: Column) -> Column:
    """The digits of u without its sign."""
    return F.ltrim(u.cast("string"), F.lit("-"))


def _power(k: Column) -> Column:
    """10^k, NULL unless it has 1 to 38 digits."""
    zeros = F.greatest(F.least(k, F.lit(MOST)), F.lit(0)).cast("int")
    return F.when(k.between(0, MOST - 1), F.rpad(F.lit("1"), zeros + 1, "0").try_cast(WHOLE))


def _without(digits: Column, size: Column, k: Column) -> Column:
    """The number of some digits without the last k."""
    n = F.greatest(F.least(size - k, F.lit(MOST)), F.lit(0)).cast("int")
    return F.when(n == 0, F.lit(0).cast(WHOLE)).otherwise(F.left(digits, n).try_cast(WHOLE))


def _signed(size: Column, *factors: Column) -> Column:
    odd = factors[0] < 0
    for factor in factors[1:]:
        odd = odd != (factor < 0)
    return F.when(odd, _minus(size)).otherwise(size).cast(WHOLE)


class Operand(NamedTuple):
    """Two columns of value ``u / 10^s``; ``u`` is NULL where there is no value."""

    u: Column
    s: Column


def _operand(u: Column, s: Column) -> Column:
    return F.struct(u.cast(WHOLE).alias("u"), s.cast("bigint").alias("s"))


def _both(a: Operand, b: Operand, use: Callable[[Operand, Operand], Column]) -> Column:
    """What ``use`` makes of two operands."""
    parts = F.struct(a.u.cast(WHOLE).alias("a"), a.s.cast("bigint").alias("as"), b.u.cast(WHOLE).alias("b"), b.s.cast("bigint").alias("bs"))
    return once(parts, lambda x: use(Operand(x["a"], x["as"]), Operand(x["b"], x["bs"])))


class Work:
    """A table that takes the steps of calculations as further columns.

    Every step is one projection over columns, and what it needs more than once is the value of a
    lambda, so that no expression holds another twice, however long the calculation.
    """

    def __init__(self, table: DataFrame, prefix: str = "exact"):
        self.table, self.prefix, self.count = table, prefix, 0

    def keep(self, *columns: Column) -> list[Column]:
        names = [f"{self.prefix}|{self.count + i}" for i in range(len(columns))]
        self.count += len(columns)
        self.table = self.table.withColumns(dict(zip(names, columns)))
        return [F.col(f"`{name}`") for name in names]

    def read(self, text: Column) -> Operand:
        """An operand from text; digits beyond the 38th are cut off."""
        return self.take(self.keep(number(text))[0])

    def take(self, x: Column) -> Operand:
        """An operand from the column of a number."""
        n = F.least(F.length(x["digits"]), F.lit(MOST))
        size = F.when(x["sign"] == 0, F.lit(0).cast(WHOLE)).otherwise(F.left(x["digits"], n).try_cast(WHOLE))
        return Operand(*self.keep(_signed(size, x["sign"]), F.when(x["sign"] == 0, F.lit(0).cast("bigint")).otherwise(n - x["place"])))

    def constant(self, value: object | None) -> Operand:
        if value is None:
            return Operand(F.lit(None).cast(WHOLE), F.lit(0).cast("bigint"))
        sign, digits, exponent = Decimal(str(value)).as_tuple()
        text = "".join(map(str, digits))
        cut = max(0, len(text) - MOST)
        u = int(text[: len(text) - cut]) * (-1 if sign else 1)
        return Operand(F.lit(Decimal(u)).cast(WHOLE), F.lit(-exponent - cut).cast("bigint"))

    def step(self, result: Column) -> Operand:
        """An operand from a struct (u, s)."""
        (both,) = self.keep(result)
        return Operand(both["u"], both["s"])

    def plus(self, a: Operand, b: Operand) -> Operand:
        def lifted(x: Operand, s: Column) -> Column:
            return F.when(x.u == 0, x.u).otherwise(F.try_multiply(x.u, _power(s - x.s)))

        def moved(x: Operand, coarse: Column) -> Column:
            shorter = once(_text(x.u), lambda digits: _signed(_without(digits, F.length(digits), x.s - coarse), x.u))
            return F.when(x.u == 0, F.lit(0).cast(WHOLE)).when(coarse >= x.s, F.try_multiply(x.u, _power(coarse - x.s))).otherwise(shorter)

        def added(x: Operand, y: Operand, s: Column, exact: Column) -> Column:
            # Where that is too wide, the finest scale at which both have 37 digits, so that their sum fits.
            room = [F.when(z.u == 0, s).otherwise(z.s + MOST - 1 - F.length(_text(z.u))) for z in (x, y)]
            wide = once(F.least(s, *room), lambda coarse: _operand(F.try_add(moved(x, coarse), moved(y, coarse)), coarse))
            return F.when(x.u.isNull() | y.u.isNull() | exact.isNotNull(), _operand(exact, s)).otherwise(wide)

        def sum_of(x: Operand, y: Operand) -> Column:
            return once(F.greatest(x.s, y.s), lambda s: once(F.try_add(lifted(x, s), lifted(y, s)), lambda exact: added(x, y, s, exact)))

        return self.step(_both(a, b, sum_of))

    def negative(self, a: Operand) -> Operand:
        return Operand(self.keep(_minus(a.u))[0], a.s)

    def minus(self, a: Operand, b: Operand) -> Operand:
        return self.plus(a, self.negative(b))

    def times(self, a: Operand, b: Operand) -> Operand:
        half = MOST // 2

        def shorter(x: Column) -> Column:
            return once(_text(x), lambda digits: _without(digits, F.length(digits), F.lit(half)))

        # Where the product is too wide: both factors with 38 digits, in halves of 19. The lowest product can't reach the result.
        def halves(x: Operand, y: Operand) -> Column:
            wide = [F.rpad(_text(z.u), MOST, "0") for z in (x, y)]
            names = ("high_a", "low_a", "high_b", "low_b")
            return F.struct(*[
                F.substring(z, start, half).cast(WHOLE).alias(name)
                for name, (z, start) in zip(names, [(z, start) for z in wide for start in (1, half + 1)])
            ])

        def added(h: Column) -> Column:
            carried = [shorter(F.try_multiply(h["high_a"], h["low_b"])), shorter(F.try_multiply(h["low_a"], h["high_b"]))]
            return F.try_add(F.try_add(F.try_multiply(h["high_a"], h["high_b"]), carried[0]), carried[1])

        def product(x: Operand, y: Operand, exact: Column) -> Column:
            lost = 2 * MOST - F.length(_text(x.u)) - F.length(_text(y.u)) - MOST
            wide = once(once(halves(x, y), added), lambda size: _operand(_signed(size, x.u, y.u), x.s + y.s + lost))
            return F.when(x.u.isNull() | y.u.isNull() | exact.isNotNull(), _operand(exact, x.s + y.s)).otherwise(wide)

        return self.step(_both(a, b, lambda x, y: once(F.try_multiply(x.u, y.u), lambda exact: product(x, y, exact))))

    def over(self, a: Operand, b: Operand) -> Operand:
        """The quotient, cut off behind 28 digits or more; no value for a divisor of zero."""
        width, step = 28, F.lit(Decimal(10) ** 10).cast(WHOLE)

        # Long division, ten digits at a time behind the first.
        def divided(rest: Column, lower: Column, more: int, before: Column | None) -> Column:
            part = F.call_function("div", rest, lower).cast(WHOLE)
            so_far = part if before is None else F.try_add(F.try_multiply(before, step), part)
            if not more:
                return so_far
            left = F.try_multiply(F.try_mod(rest, lower), step)
            return once(F.struct(so_far.cast(WHOLE).alias("u"), left.cast(WHOLE).alias("left")), lambda x: divided(x["left"], lower, more - 1, x["u"]))

        def quotient(x: Operand, y: Operand, digits: Column) -> Column:
            rest = F.rpad(digits["a"], MOST, "0").cast(WHOLE)
            lower = F.rpad(F.left(digits["b"], F.lit(width)), width, "0").cast(WHOLE)
            u = once(F.struct(rest.alias("rest"), lower.alias("lower")), lambda z: divided(z["rest"], z["lower"], 2, None))
            s = (x.s + MOST - F.length(digits["a"])) - (y.s + width - F.length(digits["b"])) + 20
            return once(u, lambda size: _operand(_signed(size, x.u, y.u), s))

        def over(x: Operand, y: Operand) -> Column:
            none, zero = _operand(F.lit(None), x.s), _operand(F.lit(0), F.lit(0))
            some = once(F.struct(_text(x.u).alias("a"), _text(y.u).alias("b")), lambda digits: quotient(x, y, digits))
            return F.when(F.coalesce(y.u == 0, F.lit(True)), none).when(x.u == 0, zero).otherwise(some)

        return self.step(_both(a, b, over))

    def size(self, a: Operand) -> Column:
        """The number of an operand without its sign."""
        return self.give(a, signed=False)

    def give(self, a: Operand, signed: bool = True) -> Column:
        """The number of an operand."""
        (digits,) = self.keep(F.when(a.u == 0, "").otherwise(_text(a.u)))
        sign = F.when(a.u == 0, 0).when((a.u < 0) & F.lit(signed), -1).otherwise(1)
        place = F.when(a.u == 0, 0).otherwise(F.length(digits) - a.s).cast("bigint")
        parts = F.struct(sign.alias("sign"), place.alias("place"), F.rtrim(digits, F.lit("0")).alias("digits"))
        return self.keep(F.when(a.u.isNotNull(), parts))[0]
