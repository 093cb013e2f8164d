from oddsline import schemas as S


def market_row(id, token_ids=None, outcomes=None, resolved=None, closed=None, category=None, created_at=None,
               end_date=None, resolution_date=None, question=None, condition_id=None, active=None):
    return (id, question, None, None, condition_id, token_ids, outcomes, active, closed, None, created_at,
            end_date, resolved, resolution_date, None, [], category)


def markets_df(spark, rows):
    return spark.createDataFrame(rows, S.MARKETS)


def two_markets(spark):
    return markets_df(spark, [
        market_row("m1", ["YES1", "NO1"], ["YES", "NO"], resolved=False, closed=False, condition_id="c1", active=True),
        market_row("m2", ["YES2", "NO2"], ["YES", "NO"], resolved=True, closed=True, condition_id="c2", active=False),
    ])
