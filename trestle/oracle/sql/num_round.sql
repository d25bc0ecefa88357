select o_orderkey, round(o_totalprice) as price_0, round(o_totalprice / 7, 2) as price_7th, round(-o_totalprice / 3) as neg_third
from orders
