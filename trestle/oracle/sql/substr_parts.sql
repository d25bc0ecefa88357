select distinct part2, substring(part2, 1, 2) as region_number, substring(part2, 3, 4) as market_number,
  left(part2, 2) as left2, right(part2, 3) as right3, lpad(left(part2, 2) || '00', 4, '0') as region_code
from fx_gl
