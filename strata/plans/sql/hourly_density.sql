-- Mean passengers of each hour against the mean hour. :gold names the month/day/hour gold table; the status
-- texts are :above, :below and :equal.
SELECT
  hour AS hora_do_dia,
  round(passengers, 4) AS media_passageiros_hora,
  round(mean_passengers, 4) AS media_global_maio_horas,
  round(passengers - mean_passengers, 4) AS desvio_da_media,
  CASE
    WHEN round(passengers - mean_passengers, 4) > 0 THEN :above
    WHEN round(passengers - mean_passengers, 4) < 0 THEN :below
    ELSE :equal
  END AS status_comportamento_cliente
FROM (
  SELECT hour, passengers, avg(passengers) OVER () AS mean_passengers
  FROM (
    SELECT HOUR_SLICE AS hour, avg(avg_passenger_count) AS passengers
    FROM IDENTIFIER(:gold)
    GROUP BY HOUR_SLICE
  )
)
ORDER BY hour
