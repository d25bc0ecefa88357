select proj_id, week_ending, 'total_float' as metric, cast(total_float as double) as value from fx_weekly
union all select proj_id, week_ending, 'resources_to_date', cast(resources_to_date as double) from fx_weekly
union all select proj_id, week_ending, 'next_week_resources', cast(next_week_resources as double) from fx_weekly
