select version_id, size_text, cast(try_cast(size_text as decimal(38,0)) as bigint) as size,
  cast(try_cast('x' || size_text as decimal(38,0)) as bigint) as bad_size
from fx_opportunity
