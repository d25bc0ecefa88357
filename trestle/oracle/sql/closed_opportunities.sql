select *, case when stage_type like '%Won%' then true else false end as opportunity_won
from q_opportunities_current where stage_type like 'Closed%'
