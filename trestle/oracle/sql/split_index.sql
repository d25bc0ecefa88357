with d as (select department, description, string_split(replace(description, 'Region - ', ''), ' ') as w from fx_dept)
select department, description, w[1] as word0, w[2] as word1, w[3] as word2 from d
