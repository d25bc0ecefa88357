with d as (select distinct trim(department) as part2, trim(glco) as glco, trim(description) as division_description from fx_dept)
select g.glco, g.part2, g.mth, g.netamt_cents, d.division_description
from fx_gl g left join d on g.glco = d.glco and g.part2 = d.part2
