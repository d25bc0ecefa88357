select distinct budget_code, gl_account, split_part(budget_code, ' ', 1) as budget_year_text,
  split_part(gl_account, '.', 2) as account_division, split_part(gl_account, '.', 5) as missing_part
from fx_budget
