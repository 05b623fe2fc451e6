-- One institution's recognised course dollars per model and fiscal year.
SELECT inst_code, newid, fiscal_year_ssi_recognized, ssi_total_amount
FROM course_allocations
WHERE inst_code = :institution
  AND ssi_total_amount IS NOT NULL
