-- Tickets per source type and reported status (runs on the registered views).
WITH t AS (
  SELECT sourceType, status FROM tickets
)
SELECT sourceType, status, COUNT(*) AS n
FROM t
GROUP BY sourceType, status
