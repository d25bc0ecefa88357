select * from q_opportunities_current where stage_type in ('Open', 'Pending')
