"""The retail tables as SQL over the test files; the mapping is in FIXTURES.md."""

from oracle.faults import FAULTS

VIEWS = {
    "o": """
    SELECT b.*,
           CAST(subtotal_amount - discount_amount + shipping_fee AS DECIMAL(12,2)) AS total_amount,
           order_date + to_hours(CAST(CASE order_status
               WHEN 'delivered' THEN 48 + (order_id * 7919) % 120
               WHEN 'returned' THEN 72 + (order_id * 31) % 48 END AS BIGINT)) AS delivery_date
    FROM (SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_date,
                 CASE WHEN o_orderkey % 20 = 0 THEN 'cancelled'
                      WHEN o_orderkey % 20 = 1 THEN 'returned'
                      WHEN o_orderstatus = 'F' THEN 'delivered'
                      WHEN o_orderstatus = 'O' THEN 'shipped'
                      WHEN o_orderkey % 2 = 0 THEN 'pending' ELSE 'processing' END AS order_status,
                 CAST(o_totalprice AS DECIMAL(12,2)) AS subtotal_amount,
                 CAST(o_orderkey % 10 AS DECIMAL(12,2)) AS shipping_fee,
                 CASE WHEN o_orderkey % 12 = 0
                      THEN CAST(CAST(o_totalprice AS DECIMAL(12,2)) * CAST(0.10 AS DECIMAL(3,2))
                                AS DECIMAL(12,2))
                      ELSE CAST(0 AS DECIMAL(12,2)) END AS discount_amount,
                 o_orderpriority AS order_priority
          FROM orders) b""",
    "i": """
    SELECT c.*, CAST(quantity * unit_price - item_discount AS DECIMAL(12,2)) AS total_price
    FROM (SELECT order_id, product_id, line_number, created_at, quantity,
                 CAST(unit_cents * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(12,2)) AS unit_price,
                 CAST(((unit_cents * (50 + product_id % 30)) // 100) * CAST(0.01 AS DECIMAL(3,2))
                      AS DECIMAL(12,2)) AS cost_price,
                 CAST(((unit_cents * quantity * discount_pct) // 100) * CAST(0.01 AS DECIMAL(3,2))
                      AS DECIMAL(12,2)) AS item_discount
          FROM (SELECT l_orderkey AS order_id, l_partkey AS product_id,
                       l_linenumber AS line_number, l_shipdate AS created_at,
                       CAST(l_quantity AS BIGINT) AS quantity,
                       CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 100 AS BIGINT)
                           // CAST(l_quantity AS BIGINT) AS unit_cents,
                       CAST(CAST(l_discount AS DECIMAL(4,2)) * 100 AS BIGINT) AS discount_pct
                FROM lineitem) a) c""",
    "p": """
    SELECT p_partkey AS product_id,
           CASE WHEN p_type IS NOT NULL THEN dense_rank() OVER (ORDER BY p_type NULLS LAST) END
               AS category_id,
           p_type AS category_name, p_name AS product_name,
           'PROD-' || CAST(p_partkey AS VARCHAR) AS sku,
           CAST((CAST(CAST(p_retailprice AS DECIMAL(12,2)) * 100 AS BIGINT)
                 * (50 + p_partkey % 30) // 100) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(12,2))
               AS cost_price,
           CAST(p_retailprice AS DECIMAL(12,2)) AS sale_price,
           CAST((p_partkey * 37) % 1200 AS INTEGER) AS stock_quantity,
           p_partkey % 17 <> 0 AS is_active
    FROM part""",
    "c": """
    SELECT c_custkey AS customer_id, split_part(c_name, '#', 1) AS first_name,
           split_part(c_name, '#', 2) AS last_name,
           lower(replace(c_name, '#', '.')) || '@example.com' AS email,
           'City ' || CAST(c_custkey % 50 AS VARCHAR) AS city, n_name AS state,
           c_mktsegment AS acquisition_channel,
           CAST(DATE '2024-01-01' + CAST(c_custkey % 30 AS INTEGER) AS TIMESTAMP) AS created_at
    FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "y": """
    SELECT order_id AS payment_id, order_id, order_priority AS payment_method,
           CASE order_status WHEN 'pending' THEN 'pending' WHEN 'returned' THEN 'refunded'
               WHEN 'cancelled' THEN
                   CASE WHEN (order_id // 20) % 10 < 7 THEN 'refunded' ELSE 'failed' END
               ELSE 'completed' END AS payment_status,
           total_amount AS amount, order_date AS transaction_timestamp,
           'TXN-' || CAST(order_id AS VARCHAR) AS gateway_transaction_id
    FROM o""",
    "r": """
    SELECT event_id AS review_id, user_id AS customer_id, 
           event_id % (SELECT max(p_partkey) + 1 FROM part) AS product_id,
           event_id AS order_id, CAST(1 + CAST(floor(value) AS BIGINT) % 5 AS SMALLINT) AS rating,
           ts AS created_at
    FROM events WHERE event_type = 'purchase'""",
}


def sql(views: str, body: str, **ctes: str) -> str:
    """``body`` with the canonical views named by letter, then further CTEs."""
    parts = [f"{v} AS ({VIEWS[v]})" for v in views] + [f"{k} AS ({v})" for k, v in ctes.items()]
    return "WITH " + ",\n".join(parts) + "\n" + body


_TABLE_OF = {"o": "orders", "i": "order_items", "p": "products", "c": "customers", "y": "payments", "r": "reviews"}


def sql_with_faults(views: str, body: str, **ctes: str) -> str:
    """As ``sql``, over the tables with planted faults; payments stem from the orders without."""
    plain = VIEWS | {"y": VIEWS["y"].replace("FROM o", f"FROM ({VIEWS['o']}) s")}
    parts = []
    for v in views:
        changed = ", ".join(f"{value} AS {c}" for c, value in FAULTS[_TABLE_OF[v]].items())
        parts.append(f"{v} AS (SELECT * REPLACE ({changed}) FROM ({plain[v]}) b)")
    parts += [f"{k} AS ({v})" for k, v in ctes.items()]
    return "WITH " + ",\n".join(parts) + "\n" + body


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def rnd(x: str, digits: int) -> str:
    """Round half away from zero, on a decimal: 1.005 as a double lies below the tie."""
    return f"CAST(round(CAST({x} AS DECIMAL(30,7)), {digits}) AS DOUBLE)"


def share(num: str, den: str, digits: int = 2) -> str:
    top, bottom = dbl(f"({num}) * 1000000"), dbl(f"({den}) * 10000")
    return rnd(f"{top} / nullif({bottom}, 0)", digits)
