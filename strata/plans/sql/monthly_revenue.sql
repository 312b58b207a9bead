-- Revenue of each month against the mean month. :gold names the monthly gold table; the label of month n is
-- :month_n, and the status texts are :above, :below and :equal.
SELECT
  CASE month
    WHEN 1 THEN :month_1
    WHEN 2 THEN :month_2
    WHEN 3 THEN :month_3
    WHEN 4 THEN :month_4
    WHEN 5 THEN :month_5
  END AS nome_mes,
  revenue AS faturamento_mes,
  round(mean_revenue, 2) AS media_historica_mensal,
  round(revenue - mean_revenue, 2) AS desvio_da_media,
  CASE
    WHEN round(revenue - mean_revenue, 2) > 0 THEN :above
    WHEN round(revenue - mean_revenue, 2) < 0 THEN :below
    ELSE :equal
  END AS status_performance
FROM (
  SELECT month, revenue, avg(revenue) OVER () AS mean_revenue
  FROM (SELECT int(TIME_SLICE) AS month, round(total_amount, 2) AS revenue FROM IDENTIFIER(:gold))
)
ORDER BY month
