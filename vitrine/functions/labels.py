"""Bands, labels and pt-BR number text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitrine.functions import first_case
from vitrine.functions.numeric import PRICE_SCALE, cents

# Price segments as (upper limit, label); the last one is open.
PRICE_SEGMENTS = [
    (1000, "Até R$1.000"),
    (2000, "R$1.000 – R$2.000"),
    (3500, "R$2.000 – R$3.500"),
    (5000, "R$3.500 – R$5.000"),
    (None, "Acima de R$5.000"),
]

# Discount bands as (label, lower bound, upper bound).  The label
# looks at both bounds, the reported bounds only at the upper one, so a value
# in the gap between two bands keeps the bounds of the band above it but takes
# the last label.
NO_DISCOUNT = ("0% (sem desconto)", "0", "0")
DISCOUNT_BANDS = [
    ("1% – 10%", "0.01", "10"),
    ("11% – 20%", "10.01", "20"),
    ("21% – 30%", "20.01", "30"),
    ("31% – 50%", "30.01", "50"),
]
ABOVE_BANDS = ("Acima de 50%", "50.01", "100")

# Display texts.
WITH_FREE_SHIPPING = "com frete grátis"
WITHOUT_FREE_SHIPPING = "sem frete grátis"
TREND_UP, TREND_DOWN, TREND_FLAT = "subiu", "caiu", "estável"
TREND_DISPLAY = {"subiu": "↑ Alta", "caiu": "↓ Queda", "estável": "→ Estável"}
CONDITION_DISPLAY = {"new": "Novo", "used": "Usado"}

BUCKET_WIDTH = 500


def price_segment(price: Column) -> Column:
    label = first_case((price < limit, text) for limit, text in PRICE_SEGMENTS[:-1])
    return label.otherwise(PRICE_SEGMENTS[-1][1])


def bucket_start(price: Column, width: int = BUCKET_WIDTH) -> Column:
    """Lower end of the price bucket; dividing DECIMALs is slow, so whole cents are used."""
    span = width * 10**PRICE_SCALE
    return (F.floor(cents(price) / span) * width).cast("int")


def bucket_end(price: Column, width: int = BUCKET_WIDTH) -> Column:
    return bucket_start(price, width) + F.lit(width - 1)


def grouped_int(number: Column) -> Column:
    """Integer with dots between thousands: 1499 -> 1.499."""
    return F.translate(F.format_number(number, 0), ",", ".")


def bucket_label(start: Column, end: Column) -> Column:
    return F.concat(F.lit("R$"), grouped_int(start), F.lit(" – R$"), grouped_int(end))


def discount_band(pct: Column) -> tuple[Column, Column, Column]:
    """Band label, lower bound and upper bound of a discount percentage."""
    label = F.when(pct == 0, NO_DISCOUNT[0])
    low = F.when(pct == 0, _bound(NO_DISCOUNT[1]))
    high = F.when(pct == 0, _bound(NO_DISCOUNT[2]))
    for text, lower, upper in DISCOUNT_BANDS:
        label = label.when(pct.between(_bound(lower), _bound(upper)), text)
        low = low.when(pct <= _bound(upper), _bound(lower))
        high = high.when(pct <= _bound(upper), _bound(upper))
    return label.otherwise(ABOVE_BANDS[0]), low.otherwise(_bound(ABOVE_BANDS[1])), high.otherwise(_bound(ABOVE_BANDS[2]))


def _bound(text: str) -> Column:
    return F.lit(text).cast("decimal(5,2)")


def shipping_label(free: Column) -> Column:
    return F.when(free, WITH_FREE_SHIPPING).otherwise(WITHOUT_FREE_SHIPPING)


def trend_label(variation_pct: Column) -> Column:
    """Direction of a rounded variation; moves within one per cent are flat."""
    return (
        F.when(variation_pct > 1, TREND_UP).when(variation_pct < -1, TREND_DOWN).otherwise(TREND_FLAT)
    )


def display(col: Column, texts: dict[str, str]) -> Column:
    """Display text for a code; codes without one are shown as they are."""
    return first_case((col == code, text) for code, text in texts.items()).otherwise(col)


def shorten(text: Column, limit: int) -> Column:
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit("..."))).otherwise(text)


def brl(amount: Column) -> Column:
    """Money as pt-BR text: 1234.5 -> ``R$ 1.234,50``; NULL -> ``R$ —``."""
    swapped = F.translate(F.format_number(amount.cast("double"), 2), ",.", ".,")
    return F.coalesce(F.concat(F.lit("R$ "), swapped), F.lit("R$ —"))


def pct_text(value: Column) -> Column:
    """Percentage as pt-BR text with one digit: 12.34 -> ``12,3%``; NULL -> ``—%``."""
    plain = F.translate(F.replace(F.format_number(value.cast("double"), 1), F.lit(","), F.lit("")), ".", ",")
    return F.concat(F.coalesce(plain, F.lit("—")), F.lit("%"))


def int_text(value: Column) -> Column:
    """Integer as pt-BR text, the fraction cut off: 1234.9 -> ``1.234``; NULL -> ``—``."""
    return F.coalesce(grouped_int(value.cast("bigint")), F.lit("—"))
