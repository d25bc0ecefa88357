select * from fx_incident where link != 'Link'
