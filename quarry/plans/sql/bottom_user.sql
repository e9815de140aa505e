-- The customers with the fewest straddling completed orders: an order
-- straddles the run date if it was created before that day began and last
-- touched when it had begun. Equal counts go by customer id.
SELECT customers.*
FROM customers
LEFT SEMI JOIN (
    SELECT customer_id
    FROM orders
    WHERE status = 'Completed' AND created_at < :run_date AND updated_at >= :run_date
    GROUP BY customer_id
    ORDER BY count(*), customer_id
    LIMIT 10
) AS fewest ON customers.id = fewest.customer_id
