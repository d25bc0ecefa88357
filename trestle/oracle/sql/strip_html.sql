select page_id, regexp_replace(regexp_replace(html, '<[^>]+>', '', 'g'), '&nbsp;', '', 'g') as text from pages
