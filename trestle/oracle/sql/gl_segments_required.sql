with p1 as (select distinct trim(instance) as inst, trim(glco) as co, trim(description) as natural_account_desc from fx_segment where partno = 1),
p3 as (select distinct trim(instance) as inst, trim(glco) as co, trim(description) as department_description from fx_segment where partno = 3)
select g.glco, g.part1, g.part3, p1.natural_account_desc, p3.department_description, count(*) as n_rows,
  cast(sum(g.netamt_cents) as bigint) as netamt_cents
from fx_gl g join p1 on g.part1 = p1.inst and g.glco = p1.co join p3 on g.part3 = p3.inst and g.glco = p3.co
group by all
