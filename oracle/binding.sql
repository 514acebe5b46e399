-- Binding of the TPC-H-like test tables to the retail star schema (DuckDB dialect).
-- Same definitions as tillpoint/sources/binding.py; every oracle query runs with these CTEs in front.
fact_orders AS (
    SELECT l.l_orderkey AS order_id,
           CAST(o.o_orderdate AS DATE) AS order_date,
           l.l_suppkey AS retailer_id,
           l.l_partkey AS product_sku,
           CAST(l.l_extendedprice AS DECIMAL(12,2)) AS product_price,
           CAST(p.p_retailprice AS DECIMAL(12,2)) * 20 AS product_cost,
           CAST(l.l_quantity AS INTEGER) AS order_quantity,
           o.o_custkey AS customer_id,
           CAST(l.l_extendedprice AS DECIMAL(12,2)) * CAST(l.l_discount AS DECIMAL(4,2)) AS product_discount
    FROM lineitem l
    JOIN orders o ON l.l_orderkey = o.o_orderkey
    LEFT JOIN part p ON l.l_partkey = p.p_partkey
),
fact_shippings AS (
    SELECT l.l_orderkey AS order_id,
           CAST(o.o_orderdate AS DATE) AS order_date,
           CAST(l.l_shipdate AS DATE) AS ship_date,
           CAST(abs(CAST(l.l_shipdate AS DATE) - CAST(o.o_orderdate AS DATE)) AS INTEGER) AS delivery_duration,
           CAST(l.l_shipdate AS DATE)
             + CAST(abs(CAST(l.l_shipdate AS DATE) - CAST(o.o_orderdate AS DATE)) AS INTEGER) AS delivery_date,
           l.l_returnflag AS shipping_method,
           o.o_orderpriority AS carrier,
           CAST(l.l_extendedprice AS DECIMAL(12,2)) * CAST(l.l_tax AS DECIMAL(4,2)) AS shipping_cost,
           CASE o.o_orderstatus WHEN 'F' THEN 'on-time' WHEN 'P' THEN 'delayed' WHEN 'O' THEN 'returned' END
             AS delivery_status,
           s.s_nationkey AS warehouse_id
    FROM lineitem l
    JOIN orders o ON l.l_orderkey = o.o_orderkey
    LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
),
fact_returns AS (
    SELECT l_orderkey AS order_id,
           l_partkey AS product_sku,
           CAST(l_quantity AS INTEGER) AS return_quantity,
           CAST(year(l_shipdate) AS INTEGER) AS return_year,
           CAST(month(l_shipdate) AS INTEGER) AS return_month,
           CAST(day(l_shipdate) AS INTEGER) AS return_day,
           l_shipdate AS returndate
    FROM lineitem
    WHERE l_returnflag = 'R'
),
dim_products AS (
    SELECT p_partkey AS product_sku,
           p_name AS product_full_description,
           CAST(NULL AS VARCHAR) AS product_gender,
           p_type AS product_category,
           p_name AS product_name,
           CAST(p_size AS VARCHAR) AS product_size,
           CAST(NULL AS VARCHAR) AS product_color
    FROM part
),
geo AS (
    SELECT n.n_nationkey, n.n_name, r.r_name
    FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
),
dim_customers AS (
    SELECT c.c_custkey AS customer_id,
           c.c_name AS customer_name,
           c.c_mktsegment AS age_group,
           CAST(NULL AS VARCHAR) AS gender,
           g.r_name AS region,
           CAST(NULL AS VARCHAR) AS channel,
           CAST(c.c_acctbal AS DECIMAL(12,2)) AS loyalty_score
    FROM customer c JOIN geo g ON c.c_nationkey = g.n_nationkey
),
dim_retailers AS (
    SELECT s.s_suppkey AS retailer_id,
           CASE s.s_suppkey % 3 WHEN 0 THEN 'online' WHEN 1 THEN 'in-store' ELSE 'distributor' END
             AS retailer_channel,
           s.s_name AS retailer_name,
           g.n_name AS city,
           g.r_name AS region,
           CAST(NULL AS VARCHAR) AS area,
           g.n_name AS country,
           CAST(s.s_acctbal AS DECIMAL(12,2)) AS distance_from_warehouse
    FROM supplier s JOIN geo g ON s.s_nationkey = g.n_nationkey
),
dim_warehouses AS (
    SELECT n_nationkey AS warehouse_id,
           n_name AS warehouse_location,
           r_name AS region,
           CAST(NULL AS INTEGER) AS capacity
    FROM geo
),
dim_promotions AS (
    SELECT p_partkey * 10 + k AS promotion_id,
           p_partkey AS product_sku,
           DATE '1995-01-01' + CAST((p_partkey * 37) % 2000 + k * 20 AS INTEGER) AS start_date,
           DATE '1995-01-01' + CAST((p_partkey * 37) % 2000 + k * 20 AS INTEGER)
             + CAST(180 + p_partkey % 60 AS INTEGER) AS end_date,
           CAST(5 + p_partkey % 46 AS DECIMAL(10,1)) AS discount_percentage,
           p_brand AS campaign_name
    FROM (SELECT p_partkey, p_brand, unnest(CASE WHEN p_size > 25 THEN [0, 1] ELSE [0] END) AS k FROM part)
),
dim_date AS (
    SELECT CAST(d AS DATE) AS date,
           CAST(year(d) AS INTEGER) AS year,
           CAST(month(d) AS INTEGER) AS month,
           CAST(quarter(d) AS INTEGER) AS quarter,
           dayname(d) AS weekday,
           false AS is_holiday
    FROM (SELECT unnest(generate_series(CAST(CAST(MIN(o_orderdate) AS DATE) AS TIMESTAMP),
                                        CAST(CAST(MAX(o_orderdate) AS DATE) AS TIMESTAMP), INTERVAL 1 DAY)) AS d
          FROM orders)
),
-- Every (SKU, day) that some promotion covers, day by day; an order is flagged if its day is among them.
promotion_days AS (
    SELECT DISTINCT product_sku,
           CAST(unnest(generate_series(CAST(start_date AS TIMESTAMP), CAST(end_date AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS covered
    FROM dim_promotions
),
orders_flagged AS (
    SELECT o.*, d.covered IS NOT NULL AS is_promotion_active
    FROM fact_orders o
    LEFT JOIN promotion_days d ON d.product_sku = o.product_sku AND d.covered = o.order_date
),
order_amounts AS (
    SELECT *,
           order_quantity * product_price AS line_revenue,
           order_quantity * (product_price - product_cost) AS line_profit
    FROM fact_orders
),
-- Tile i of five ends after i * (n / 5) customers, and one more for each of the first n % 5 tiles.
tile_ends AS (
    SELECT i * (n // 5) + least(i, n % 5) AS last_place
    FROM (SELECT count(DISTINCT customer_id) AS n FROM fact_orders), range(1, 6) AS tile(i)
),
customer_tiles AS (
    SELECT customer_id, recency, frequency, monetary,
           CAST(1 + (SELECT count(*) FROM tile_ends WHERE last_place < by_recency) AS INTEGER) AS r_score,
           CAST(1 + (SELECT count(*) FROM tile_ends WHERE last_place < by_frequency) AS INTEGER) AS f_score,
           CAST(1 + (SELECT count(*) FROM tile_ends WHERE last_place < by_monetary) AS INTEGER) AS m_score
    FROM (SELECT customer_id,
                 CAST(min(DATE '2001-08-02' - order_date) AS INTEGER) AS recency,
                 count(order_id) AS frequency,
                 sum(line_revenue - product_discount) AS monetary,
                 row_number() OVER (ORDER BY recency, customer_id) AS by_recency,
                 row_number() OVER (ORDER BY frequency DESC, customer_id) AS by_frequency,
                 row_number() OVER (ORDER BY monetary DESC, customer_id) AS by_monetary
          FROM order_amounts GROUP BY customer_id)
)
