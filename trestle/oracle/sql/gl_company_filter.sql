select glco, count(*) as n_rows, if(glco in (from fx_excluded_company), 0, 1) as include_company
from fx_gl group by glco
