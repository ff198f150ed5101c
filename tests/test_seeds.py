"""Golden numbers recomputable from the six-row expense seeds:
CSV read with the forced all-text schema → staging → expenses by channel."""

from decimal import Decimal

from funnelworks.plans.intermediate import int_expenses_channel_month
from funnelworks.plans.staging import stg_expenses_advertising, stg_expenses_salary
from funnelworks.sources.files import read_advertising_csv, read_salary_csv

NB = "\u00a0"
# The published seed rows.
ADS = [("Jan-24", "55 779,40"), ("Feb-24", "65 579,08"), ("Mar-24", "67 976,84"), ("Apr-24", "63 071,31"),
       ("May-24", "54 317,52"), ("Jun-24", "56 777,16")]
SALARY = [("Jan-24", "38 075,75", "39 216,00"), ("Feb-24", "43 051,00", "37 235,25"),
          ("Mar-24", "44 278,25", "39 880,00"), ("Apr-24", "47 024,25", "40 269,00"),
          ("May-24", "48 108,25", "44 803,25"), ("Jun-24", "50 000,00", "47 500,00")]
EXPECTED = {  # month: (outbound total, inbound total)
    "2024-01-01": ("38075.75", "94995.40"),
    "2024-02-01": ("43051.00", "102814.33"),
    "2024-03-01": ("44278.25", "107856.84"),
    "2024-04-01": ("47024.25", "103340.31"),
    "2024-05-01": ("48108.25", "99120.77"),
    "2024-06-01": ("50000.00", "104277.16"),
}


def money(v: str) -> str:
    return '"US$\t' + v.replace(" ", NB) + '"'


def write(path, header, rows):
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(header + "\n")
        for r in rows:
            fh.write(",".join([r[0]] + [money(v) for v in r[1:]]) + "\n")


def test_expense_golden_numbers(spark, tmp_dir):
    write(f"{tmp_dir}/ads.csv", "MONTH,ADVERTISING", ADS)
    write(f"{tmp_dir}/sal.csv", "MONTH,OUTBOUND_SALES_TEAM,INBOUND_SALES_TEAM", SALARY)
    ads = stg_expenses_advertising(read_advertising_csv(spark, f"{tmp_dir}/ads.csv"))
    sal = stg_expenses_salary(read_salary_csv(spark, f"{tmp_dir}/sal.csv"))
    out = int_expenses_channel_month(sal, ads).collect()
    assert len(out) == 12
    got = {(str(r.month_date), r.channel): r.total_cost_usd for r in out}
    for month, (outbound, inbound) in EXPECTED.items():
        assert got[(month, "outbound")] == Decimal(outbound)
        assert got[(month, "inbound")] == Decimal(inbound)
    # advertising is attributed to inbound only
    assert all(r.advertising_spend_usd == 0 for r in out if r.channel == "outbound")
