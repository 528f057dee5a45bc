"""Ten customers, products and orders with hand-checked totals.

Names are invented; amounts, dates and keys give the golden numbers in the tests.
"""

from datetime import datetime
from decimal import Decimal

from orderlens import schemas

TIERS = dict(c1="ENTERPRISE", c2="ENTERPRISE", c3="PREMIUM", c4="STANDARD", c5="ENTERPRISE",
             c6="ENTERPRISE", c7="PREMIUM", c8="ENTERPRISE", c9="PREMIUM", c10="STANDARD")
LTV = dict(c1=150000, c2=275000, c3=45000, c4=85000, c5=320000, c6=425000, c7=78000, c8=680000, c9=195000, c10=32000)
PRODUCTS = [
    ("p1", "Lantern", "Software", 5000, 1500, 100), ("p2", "Mosaic", "Software", 2500, 800, 150),
    ("p3", "Thicket", "Software", 7500, 2000, 75), ("p4", "Pebble", "Software", 1200, 400, 300),
    ("p5", "Conduit", "Software", 3500, 1000, 120), ("p6", "Rampart", "Security", 4800, 1200, 90),
    ("p7", "Cellar", "Software", 6200, 1800, 60), ("p8", "Turnstile", "Infrastructure", 3800, 900, 110),
    ("p9", "Pocket", "Software", 2200, 600, 200), ("p10", "Beacon", "Platform", 8500, 2500, 45),
]
ORDERS = [
    ("o1", "c1", "2024-01-15 10:30:00", 12500, "COMPLETED", 0, 1250), ("o2", "c2", "2024-01-20 14:15:00", 10000, "COMPLETED", 500, 950),
    ("o3", "c3", "2024-02-01 09:45:00", 7500, "PROCESSING", 0, 750), ("o4", "c4", "2024-02-05 16:20:00", 6000, "SHIPPED", 300, 570),
    ("o5", "c5", "2024-02-10 11:00:00", 14000, "PENDING", 700, 1330), ("o6", "c6", "2024-02-12 13:30:00", 18500, "COMPLETED", 925, 1665),
    ("o7", "c7", "2024-02-14 10:15:00", 5400, "SHIPPED", 270, 486), ("o8", "c8", "2024-02-16 15:45:00", 25000, "PROCESSING", 1250, 2250),
    ("o9", "c9", "2024-02-18 12:00:00", 8700, "COMPLETED", 435, 783), ("o10", "c10", "2024-02-20 09:30:00", 3400, "PENDING", 170, 306),
]
ITEMS = [
    ("o1", "p1", 2, 5000), ("o1", "p2", 1, 2500), ("o2", "p1", 2, 5000), ("o3", "p3", 1, 7500), ("o4", "p2", 1, 2500),
    ("o4", "p4", 3, 1200), ("o5", "p1", 1, 5000), ("o5", "p3", 1, 7500), ("o5", "p4", 1, 1200), ("o6", "p6", 2, 4800),
    ("o6", "p7", 1, 6200), ("o6", "p2", 1, 2500), ("o7", "p8", 1, 3800), ("o7", "p9", 1, 2200), ("o8", "p10", 2, 8500),
    ("o8", "p1", 1, 5000), ("o8", "p3", 1, 7500), ("o9", "p6", 1, 4800), ("o9", "p8", 1, 3800), ("o10", "p9", 1, 2200),
    ("o10", "p4", 1, 1200),
]


def ts(text):
    return datetime.fromisoformat(text)


class Seed:
    def __init__(self, spark):
        self.spark = spark
        created = ts("2024-01-01 00:00:00")
        self.customers = spark.createDataFrame(
            [
                (k, f"Name {k}", f"{k}@example.org", None, f'{{"street":"{k} road","city":"Town","state":"TS"}}', TIERS[k],
                 Decimal(LTV[k]), True, ["B2B"], 90, created, created)
                for k in TIERS
            ],
            schemas.CUSTOMERS,
        )
        self.products = spark.createDataFrame(
            [
                (k, n, c, Decimal(p), Decimal(q), None, True, stock, '{"vendor":"V","support_level":"Basic"}', None)
                for k, n, c, p, q, stock in PRODUCTS
            ],
            schemas.PRODUCTS,
        )
        self.orders = spark.createDataFrame(
            [
                (k, c, ts(d), Decimal(a), s, None, None, Decimal(disc), Decimal(tax), ts(d))
                for k, c, d, a, s, disc, tax in ORDERS
            ],
            schemas.ORDERS,
        )
        self.items = spark.createDataFrame(
            [
                (f"i{n}", o, p, q, Decimal(u), Decimal(u * q)) for n, (o, p, q, u) in enumerate(ITEMS)
            ],
            schemas.ORDER_ITEMS,
        )
        self.jobs = spark.createDataFrame(
            [
                ("j1", "a", "REPORT", "COMPLETED", "u", ts("2024-02-12 01:00:00"), ts("2024-02-12 01:05:00"), '{"report_type":"sales_report"}', None, None, Decimal("45.2"), 1, 0, 3, [], None),
                ("j2", "b", "ANALYSIS", "FAILED", "u", ts("2024-02-12 02:00:00"), ts("2024-02-12 02:00:00"), "{}", None, "boom", Decimal("10"), 1, 3, 3, [], None),
                ("j3", "c", "DATA_SYNC", "RUNNING", "u", ts("2024-02-12 03:59:00"), None, "not json", None, None, None, 2, 0, 3, [], '{"schedule":"daily"}'),
                ("j4", "d", "REPORT", "PENDING", "u", ts("2024-02-12 05:00:00"), None, None, None, None, None, 3, 0, 3, [], None),
                ("j5", "e", "REPORT", "FAILED", "u", ts("2024-02-12 06:00:00"), ts("2024-02-12 06:10:00"), None, None, "boom", None, 3, 1, 3, [], None),
            ],
            schemas.JOBS,
        )
