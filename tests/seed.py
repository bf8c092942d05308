"""A history of invented products, from a rule: five products over six days, one price step a day."""

import csv

from vitrine.schemas import SEED

DAYS = 6
# product, title, brand, first price, daily step, original, rating, first ratings, volume text, offers
PRODUCTS = [
    ("LOJA-C", "Celular Cedro Verde", "Cedro", 640, 0, 700, 4.0, 1000, "Mais de 700 compras", 4),
    ("LOJA-E", "Celular Boreal Nota 3", "Boreal", 980, -1, 1100, 4.1, 300, "", 1),
    ("LOJA-B", "Celular Boreal Nota 7", "Boreal", 2400, -12, 2600, 4.7, 900, "Mais de 2 mil compras", 1),
    ("LOJA-D", "Celular Duna Nove", "Duna", 4000, 40, 4800, 4.5, 2000, "Mais de 3,5 mil compras", 1),
    ("LOJA-A", "Celular Aurora Lince", "Aurora", 1200, -30, 1500, 4.2, 100, "Mais de 300 compras", 2),
]


def rows():
    for day in range(DAYS):
        stamp = f"2025-11-{10 + day:02d} 09:00:00+00"
        for n, (product, title, brand, price, step, original, rating, ratings, volume, offers) in enumerate(PRODUCTS):
            now = price + step * day
            yield {
                "ingestion_id": f"seed-{n + 1:03d}-{day}", "batch_id": "history", "source": "amazon_br",
                "collected_at": stamp, "inserted_at": stamp, "product_id": product, "title": title, "brand": brand,
                "condition": "new", "url": f"https://example.com/item/{product}", "thumbnail_url": "",
                "price": f"{now}.00", "original_price": f"{original}.00",
                "discount_pct": f"{(original - now) / original * 100:.2f}", "currency": "BRL", "rating": rating,
                "num_ratings": ratings + day, "is_best_seller": "false", "is_amazon_choice": str(rating > 4.4).lower(),
                "is_prime": str(offers == 1).lower(), "free_shipping": "true", "delivery_text": "Entrega GRÁTIS",
                "sales_volume": volume, "num_offers": offers, "seed_flag": "true",
            }


def write(path):
    with open(path, "w", newline="", encoding="utf-8") as out:
        writer = csv.DictWriter(out, SEED.fieldNames())
        writer.writeheader()
        writer.writerows(rows())
    return path
