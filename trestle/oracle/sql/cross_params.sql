with d as (select distinct glco, mth from fx_gl), p as (select max(mth) as max_mth from fx_gl)
select d.glco, d.mth, p.max_mth,
  cast((year(p.max_mth) - year(d.mth)) * 12 + month(p.max_mth) - month(d.mth) as int) as months_behind
from d cross join p
