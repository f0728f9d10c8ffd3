"""The landed raw datasets: key and partition date of each.

full: refreshed as a whole; day, month_end, period, ex_date: touched partitions are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class RawDataset:
    name: str
    strategy: str
    keys: tuple[str, ...]
    partition: str | None
    #: The fetches whose union is the dataset; empty where any number of them may come.
    fetches: tuple[str, ...] = ()


# Dataset, strategy, key columns, partition column.
_TEXT = """
trade_cal            full       exchange,cal_date                                    -
stock_basic          full       ts_code                                              -
index_basic          full       ts_code                                              -
index_classify       full       index_code                                           -
index_member_all     full       ts_code,l1_code,in_date                              -
stock_daily          day        ts_code,trade_date                                   trade_date
stock_weekly         day        ts_code,trade_date                                   trade_date
stock_monthly        day        ts_code,trade_date                                   trade_date
adj_factor           day        ts_code,trade_date                                   trade_date
stock_daily_basic    day        ts_code,trade_date                                   trade_date
moneyflow            day        ts_code,trade_date                                   trade_date
moneyflow_hsgt       day        trade_date                                           trade_date
margin               day        trade_date,exchange_id                               trade_date
limit_list_d         day        trade_date,ts_code                                   trade_date
stock_st             day        ts_code,trade_date                                   trade_date
suspend              day        ts_code,trade_date                                   trade_date
sw_daily             day        ts_code,trade_date                                   trade_date
index_daily          day        ts_code,trade_date                                   trade_date
index_daily_basic    day        ts_code,trade_date                                   trade_date
index_weight         month_end  index_code,con_code,trade_date                       trade_date
income               period     ts_code,end_date,ann_date,f_ann_date,update_flag     end_date
balancesheet         period     ts_code,end_date,ann_date,f_ann_date,update_flag     end_date
cashflow             period     ts_code,end_date,ann_date,f_ann_date,update_flag     end_date
dividend             ex_date    ts_code,end_date,ex_date,div_proc,update_flag        ex_date
disclosure_date      period     ts_code,end_date                                     end_date
fund_basic           full       ts_code                                              -
fund_daily           day        ts_code,trade_date                                   trade_date
fund_adj             day        ts_code,trade_date                                   trade_date
fund_share           day        ts_code,trade_date                                   trade_date
fund_factor_pro      day        ts_code,trade_date                                   trade_date
fund_nav             day        ts_code,nav_date                                     nav_date
"""


# Datasets that are the union of several fetches.
UNIONS = {"stock_basic": ("L", "D"), "index_member_all": ("Y", "N")}


def _parse() -> dict[str, RawDataset]:
    out = {}
    for line in _TEXT.strip().splitlines():
        name, strategy, keys, partition = line.split()
        out[name] = RawDataset(name, strategy, tuple(keys.split(",")), None if partition == "-" else partition, UNIONS.get(name, ()))
    return out


RAW_DATASETS = _parse()
