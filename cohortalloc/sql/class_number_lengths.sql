-- Longest and shortest class numbers of eligible, completed, final enrollments by term.
SELECT t.strm,
       count(*) AS n_rows,
       max(length(e.class_nbr)) AS max_length,
       min(length(e.class_nbr)) AS min_length
FROM enrollments e
JOIN term_lookup t ON t.term_code = replace(e.term_code, 'F', '')
WHERE e.subsidy_eligible_code = :eligible
  AND e.completed_flag = :completed
  AND endswith(e.term_code, 'F')
GROUP BY t.strm
