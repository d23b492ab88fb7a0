"""DuckDB text of the mart building blocks and the marts."""

from __future__ import annotations

from carrymark.sources.sample_columns import SAMPLE_AS_OF
from verification.relations import quarter_end

TODAY = f"date '{SAMPLE_AS_OF}'"
FIRST = f"cast(date_trunc('month', {TODAY}) as date)"


def to_date(kind: str, types: str, name: str) -> str:
    """Flows up to each reporting date by a correlated subquery."""
    return f"""
        select m.fund_id, m.period_end_date, m.copies * (
            select sum(f.amount_converted)
            from dim_instruments h, fct_instrument_cashflows f
            where h.fund_id = m.fund_id and h.instrument_type = '{kind}'
              and f.instrument_id = h.instrument_id and f.date <= m.period_end_date
              and f.instrument_cashflow_type in ({types})) as {name}
        from reporting_dates m
        where m.fund_id in (select fund_id from dim_instruments where instrument_type = '{kind}')"""


BLOCKS = {
    "reporting_dates": "select fund_id, period_end_date, count(*) copies from fct_fund_snapshots "
                       "group by all",
    "snapshot_lines": """
        select i.fund_id, i.instrument_id, i.instrument_type, s.period_end_date,
               s.fair_value_converted fv, c.instrument_snapshot_id credit_id,
               c.principal_outstanding_converted principal, c.undrawn_commitment_converted undrawn
        from fct_instrument_snapshots s
        join dim_instruments i on i.instrument_id = s.instrument_id
        left join fct_instrument_snapshots_credit c
          on c.instrument_snapshot_id = s.instrument_snapshot_id""",
    "instrument_valuations": """
        select fund_id, period_end_date, sum(fv) total_instrument_fair_value
        from snapshot_lines where instrument_type = 'EQUITY' group by all""",
    "position_counts": """
        select fund_id, period_end_date, count(distinct instrument_id) filter (
            where (instrument_type = 'EQUITY' and fv > 0)
               or (instrument_type = 'CREDIT' and principal > 0)) number_of_positions
        from snapshot_lines group by all""",
    "credit_exposure": """
        select fund_id, period_end_date, sum(principal) lines_of_credit_outstanding,
               sum(principal) total_principal_outstanding, sum(undrawn) total_undrawn_commitment,
               sum(principal) + sum(undrawn) total_credit_exposure
        from snapshot_lines where credit_id is not null group by all""",
    "portfolio_company_counts": """
        select m.fund_id, m.period_end_date, (
            select count(distinct h.company_id) from dim_instruments h
            where h.fund_id = m.fund_id and h.inception_date <= m.period_end_date
              and coalesce(h.termination_date, date '9999-12-31') > m.period_end_date
        ) number_of_portfolio_companies
        from reporting_dates m""",
    "period_net_flows": f"""
        select h.fund_id, {quarter_end('f.date')} period_end_date, sum(f.amount_converted *
            case when f.instrument_cashflow_type in ('CONTRIBUTION', 'PURCHASE', 'DRAW') then 1
                 when f.instrument_cashflow_type in
                      ('DISTRIBUTION', 'DIVIDEND', 'SALE', 'PRINCIPAL', 'PREPAYMENT') then -1
                 else 0 end) period_net_flows
        from fct_instrument_cashflows f, dim_instruments h
        where f.instrument_id = h.instrument_id group by all""",
    "cumulative_distributions": to_date(
        "EQUITY", "'DISTRIBUTION', 'DIVIDEND', 'EXIT_PROCEEDS', 'RETURN_OF_CAPITAL'",
        "total_distributions_calculated"),
    "cumulative_called_capital": to_date(
        "EQUITY", "'INVESTMENT', 'PURCHASE'", "called_capital_calculated"),
    "cumulative_credit_interest": to_date("CREDIT", "'INTEREST'", "total_interest_income"),
    "fund_lines": """
        select f.fund_id, f.name fund_name, f.type fund_type, s.period_end_date,
               s.committed_capital, s.called_capital, s.total_distributions, s.expected_coc,
               s.total_interest_income reported_interest,
               if(f.type <> 'CREDIT', s.nav_amount_converted, null) nav_r,
               if(f.type <> 'CREDIT', coalesce(v.total_instrument_fair_value, 0)
                                      + coalesce(s.cash_amount, 0), null) nav_c,
               if(f.type = 'EQUITY', ccc.called_capital_calculated, s.called_capital) called_c,
               if(f.type = 'EQUITY', cdc.total_distributions_calculated,
                  s.total_distributions) paid_c,
               n.number_of_portfolio_companies companies, p.number_of_positions positions,
               x.lines_of_credit_outstanding principal, x.total_undrawn_commitment undrawn,
               x.total_credit_exposure exposure, ci.total_interest_income credit_interest,
               q.period_net_flows flows
        from fct_fund_snapshots s
        join dim_funds f using (fund_id)
        left join instrument_valuations v using (fund_id, period_end_date)
        left join position_counts p using (fund_id, period_end_date)
        left join credit_exposure x using (fund_id, period_end_date)
        left join portfolio_company_counts n using (fund_id, period_end_date)
        left join period_net_flows q using (fund_id, period_end_date)
        left join cumulative_distributions cdc using (fund_id, period_end_date)
        left join cumulative_called_capital ccc using (fund_id, period_end_date)
        left join cumulative_credit_interest ci using (fund_id, period_end_date)""",
    "fund_choices": """
        select *, coalesce(nav_r, nav_c) nav, coalesce(called_capital, called_c) called,
               coalesce(total_distributions, paid_c) paid from fund_lines""",
    "metrics_fund_performance": f"""
        select fund_id, fund_name, fund_type, period_end_date, nav_r fund_nav_reported,
               nav_c fund_nav_calculated, nav fund_nav, nav_r - nav_c nav_variance,
               cast(nav_r - nav_c as double) / nullif(nav_c, 0) nav_variance_pct,
               committed_capital total_commitments, called_capital called_capital_reported,
               called_c called_capital_calculated,
               total_distributions total_distributions_reported,
               paid_c total_distributions_calculated, called total_called_capital,
               paid total_distributions,
               called_capital - called_c called_capital_variance,
               cast(called_capital - called_c as double) / nullif(called_c, 0)
                   called_capital_variance_pct,
               total_distributions - paid_c distributions_variance,
               cast(total_distributions - paid_c as double) / nullif(paid_c, 0)
                   distributions_variance_pct,
               committed_capital - called_capital unfunded_commitment,
               if(fund_type <> 'CREDIT', cast(paid as double) / nullif(called, 0), null) dpi,
               if(fund_type <> 'CREDIT', cast(nav as double) / nullif(called, 0), null) rvpi,
               if(fund_type <> 'CREDIT', cast(nav + paid as double) / nullif(called, 0), null) tvpi,
               dpi dpi_calculated, rvpi rvpi_calculated, tvpi tvpi_calculated, expected_coc,
               coalesce(companies, 0) number_of_portfolio_companies,
               coalesce(positions, 0) number_of_positions,
               coalesce(principal, 0) lines_of_credit_outstanding,
               (select max(coalesce(b.principal, 0)) from fund_choices b
                where b.fund_id = a.fund_id and b.period_end_date <= a.period_end_date)
                   peak_outstanding_credit,
               if(fund_type = 'EQUITY', null, exposure) total_exposure,
               if(fund_type = 'EQUITY', null, principal) principal_outstanding,
               if(fund_type = 'EQUITY', null, undrawn) undrawn_commitment,
               if(fund_type = 'CREDIT', coalesce(credit_interest, 0), reported_interest)
                   interest_income,
               coalesce(flows, 0) period_net_flows, {TODAY} as_of_date
        from fund_choices a""",
    "metrics_returns_cashflows": """
        select h.fund_id, d.name fund_name, h.instrument_id, h.name instrument_name, h.company_id,
               c.name company_name, f.date cashflow_date, f.instrument_cashflow_type cashflow_type,
               f.amount_converted cashflow_amount, f.currency_code, f.fx_rate,
               if(f.instrument_cashflow_type in ('INVESTMENT', 'DRAW'), 'outflow', 'inflow')
                   direction,
               f.amount_converted
                   * if(f.instrument_cashflow_type in ('INVESTMENT', 'DRAW'), -1, 1) signed_amount
        from dim_funds d
        join dim_instruments h on h.fund_id = d.fund_id
        join fct_instrument_cashflows f on f.instrument_id = h.instrument_id
        left join dim_companies c on c.company_id = h.company_id""",
    **{f"metrics_portfolio_overview{suffix}": f"""
        select m.period_end_date, sum(fund_nav) total_nav, sum(total_commitments)
                   total_commitments, sum(total_called_capital) total_called_capital,
               sum(unfunded_commitment) total_unfunded_commitment,
               sum(m.total_distributions) total_distributions,
               sum(dpi * cast(m.total_commitments as double)) / sum(m.total_commitments)
                   dpi_portfolio,
               sum(rvpi * cast(m.total_commitments as double)) / sum(m.total_commitments)
                   rvpi_portfolio,
               sum(tvpi * cast(m.total_commitments as double)) / sum(m.total_commitments)
                   tvpi_portfolio,
               count(distinct fund_id) number_of_funds,
               sum(number_of_portfolio_companies) number_of_companies,
               sum(number_of_positions) number_of_positions,
               coalesce((select sum(case direction when 'outflow' then cashflow_amount
                                                   else -cashflow_amount end)
                         from metrics_returns_cashflows r
                         where {bucket} = m.period_end_date), 0) net_cash_contributions_period,
               {TODAY} as_of_date
        from metrics_fund_performance m group by m.period_end_date"""
       for suffix, bucket in (("", "cast(date_trunc('quarter', r.cashflow_date) as date)"),
                              ("_quarter_end", quarter_end("r.cashflow_date")))},

    # --- positions -----------------------------------------------------------
    "newest_snapshots": """
        select * from fct_instrument_snapshots qualify row_number() over (
            partition by instrument_id order by period_end_date desc nulls first,
            instrument_snapshot_id desc) = 1""",
    "newest_credit": """
        select s.instrument_id, s.period_end_date, c.* exclude (instrument_snapshot_id)
        from fct_instrument_snapshots_credit c
        join fct_instrument_snapshots s using (instrument_snapshot_id)
        qualify row_number() over (partition by s.instrument_id
            order by s.period_end_date desc nulls first, s.instrument_snapshot_id desc) = 1""",
    "newest_stakes": """
        select s.instrument_id, e.equity_stake_pct
        from fct_instrument_snapshots_equity e
        join fct_instrument_snapshots s using (instrument_snapshot_id)
        qualify row_number() over (partition by s.instrument_id
            order by s.period_end_date desc nulls first, s.instrument_snapshot_id desc) = 1""",
    "typed_flows": """
        select instrument_id, instrument_cashflow_type t, sum(amount_converted) a
        from fct_instrument_cashflows group by all""",
    "position_lines": f"""
        select h.*, d.name fund_name, d.type fund_type, c.name company_name,
               s.period_end_date, s.fair_value_converted, e.initial_cost_converted,
               e.initial_ownership_pct, k.equity_stake_pct, x.principal_outstanding_converted,
               x.undrawn_commitment_converted, x.accrued_interest_converted,
               l.commitment_amount_converted, l.spread_bps, l.interest_index, l.maturity_date,
               l.security_rank,
               ({TODAY} + 0 - h.inception_date) / 365.25::double open_years,
               (h.termination_date - h.inception_date) / 365.25::double closed_years,
               coalesce((select sum(a) from typed_flows t where t.instrument_id = h.instrument_id
                         and t.t in ('EXIT_PROCEEDS', 'RETURN_OF_CAPITAL', 'DIVIDEND')), 0) proceeds,
               coalesce((select sum(a) from typed_flows t where t.instrument_id = h.instrument_id
                         and t.t = 'DRAW'), 0) draws,
               coalesce((select sum(a) from typed_flows t where t.instrument_id = h.instrument_id
                         and t.t in ('PRINCIPAL', 'PREPAYMENT')), 0) repaid,
               coalesce((select sum(a) from typed_flows t where t.instrument_id = h.instrument_id
                         and t.t = 'INTEREST'), 0) interest
        from dim_instruments h
        join newest_snapshots s on s.instrument_id = h.instrument_id
        join dim_funds d on d.fund_id = h.fund_id
        left join dim_companies c on c.company_id = h.company_id
        left join dim_instruments_equity e on e.instrument_id = h.instrument_id
        left join dim_instruments_credit l on l.instrument_id = h.instrument_id
        left join newest_credit x on x.instrument_id = h.instrument_id
        left join newest_stakes k on k.instrument_id = h.instrument_id
        where s.period_end_date is not null""",
    "equity_positions": """
        select *, coalesce(closed_years, open_years) held,
               proceeds + coalesce(fair_value_converted, 0) worth,
               if(initial_cost_converted > 0, cast(worth as double) / initial_cost_converted, null)
                   multiple
        from position_lines where instrument_type = 'EQUITY'""",
    "metrics_position_performance": f"""
        select instrument_id, name instrument_name, instrument_type, period_end_date, fund_id,
               fund_name, fund_type, company_id, company_name,
               inception_date initial_investment_date, termination_date exit_date,
               held holding_period_years, initial_cost_converted cost_basis,
               proceeds realized_proceeds, coalesce(fair_value_converted, 0) fair_value,
               initial_ownership_pct ownership_pct_initial, equity_stake_pct ownership_pct_current,
               multiple moic,
               if(multiple > 0 and held > 0, power(multiple, 1 / held) - 1, null)
                   equity_irr_approx,
               null drawn_amount, null interest_income, null principal_repaid,
               null principal_outstanding, null undrawn_commitment, null accrued_interest,
               null commitment_amount, null spread_bps, null interest_index,
               cast(null as date) maturity_date, null security_rank, null utilization_rate,
               null maturity_year, null days_to_maturity, null all_in_yield
        from equity_positions
        union all by name
        select instrument_id, name instrument_name, instrument_type, period_end_date, fund_id,
               fund_name, fund_type, company_id, company_name,
               inception_date initial_investment_date, termination_date exit_date,
               coalesce(closed_years, open_years) holding_period_years,
               draws - repaid drawn_amount, interest interest_income, repaid principal_repaid,
               principal_outstanding_converted principal_outstanding,
               undrawn_commitment_converted undrawn_commitment,
               accrued_interest_converted accrued_interest,
               commitment_amount_converted commitment_amount, spread_bps, interest_index,
               maturity_date, security_rank,
               if(commitment_amount_converted > 0, cast(principal_outstanding_converted as double)
                   / commitment_amount_converted, null) utilization_rate,
               year(maturity_date) maturity_year, maturity_date - {TODAY} days_to_maturity,
               spread_bps / 10000.0::double all_in_yield
        from position_lines where instrument_type = 'CREDIT'""",

    # --- companies -----------------------------------------------------------
    "primary_country_links": """
        select b.company_id, c.name, b.valid_from, b.valid_to
        from br_company_countries b, dim_countries c
        where b.country_code = c.country_iso2_code and b.primary_flag""",
    "primary_industry_links": """
        select b.company_id, d.name, b.valid_from, b.valid_to
        from br_company_industries b, dim_industries d
        where b.industry_id = d.industry_id and b.primary_flag""",
    **{f"metrics_company_performance{suffix}": f"""
        select c.company_id, c.name company_name,
               (select min(l.name) from primary_country_links l
                where l.company_id = c.company_id {valid}) primary_country,
               (select min(l.name) from primary_industry_links l
                where l.company_id = c.company_id {valid}) primary_industry,
               c.website, c.description, r.period_end_date, r.revenue, r.ebitda,
               cast(r.ebitda as double) / nullif(r.revenue, 0) * 100 ebitda_margin, r.cash,
               r.total_assets, r.total_liabilities, r.equity,
               r.total_liabilities - r.cash net_debt, v.amount enterprise_value,
               cast(v.amount as double) / nullif(r.ebitda, 0) ev_to_ebitda,
               cast(v.amount as double) / nullif(r.revenue, 0) ev_to_revenue,
               r.currency_code reporting_currency
        from fct_company_financials r
        join dim_companies c on c.company_id = r.company_id
        left join (select * from fct_company_valuations where valuation_type = 'ACTUAL'
                   qualify row_number() over (partition by company_id, period_end_date
                                              order by company_valuation_id) = 1) v
          on v.company_id = r.company_id and v.period_end_date = r.period_end_date"""
       for suffix, valid in (
           ("", ""),
           ("_as_of", "and coalesce(l.valid_from <= r.period_end_date, true) "
                      "and coalesce(l.valid_to >= r.period_end_date, true)"))},

    # --- exposure ------------------------------------------------------------
    "deployed_by_instrument": """
        select h.instrument_id, h.fund_id, h.company_id, h.instrument_type, s.period_end_date,
               cast(if(h.instrument_type = 'EQUITY', coalesce(s.fair_value_converted, s.fair_value),
                  coalesce(x.principal_outstanding_converted, 0)
                  + coalesce(x.undrawn_commitment_converted, 0)) as decimal(28,6)) exposure_usd,
               x.maturity_date, year(x.maturity_date) maturity_year, x.security_rank
        from newest_snapshots s
        join dim_instruments h on h.instrument_id = s.instrument_id
        left join (select n.*, l.maturity_date, l.security_rank
                   from newest_credit n join dim_instruments_credit l using (instrument_id)) x
          on x.instrument_id = h.instrument_id
        where (h.instrument_type = 'EQUITY' and s.fair_value is not null)
           or (h.instrument_type = 'CREDIT' and
               coalesce(x.principal_outstanding_converted, x.undrawn_commitment_converted)
               is not null)""",
    **{f"deployed_base{suffix}": f"""
        select e.fund_id, f.name fund_name, e.instrument_type,
               coalesce(c.region, 'Unknown Region') region,
               coalesce(bc.country_code, 'UNKNOWN') country_code,
               coalesce(c.name, 'Unknown Country') country_name,
               coalesce(bi.industry_id, 'UNKNOWN') industry_id,
               coalesce(d.name, 'Unknown Industry') industry_name, e.maturity_year,
               e.security_rank,
               sum(cast(cast(e.exposure_usd as decimal(28,6))
                        * cast(coalesce(bi.allocation_pct, 100) * coalesce(bc.allocation_pct, 100)
                               / 10000 as decimal(9,8)) as decimal(38,10)))
                   deployed_capital_usd,
               max(e.period_end_date) as_of_date
        from deployed_by_instrument e
        join dim_funds f on f.fund_id = e.fund_id
        left join br_instrument_countries bc on bc.instrument_id = e.instrument_id {valid}
        left join dim_countries c on c.country_iso2_code = bc.country_code
        left join br_instrument_industries bi on bi.instrument_id = e.instrument_id
             and e.period_end_date between coalesce(bi.valid_from, date '0001-01-01')
                                       and coalesce(bi.valid_to, date '9999-12-31')
        left join dim_industries d on d.industry_id = bi.industry_id
        group by all"""
       for suffix, valid in (
           ("", ""),
           ("_valid_countries",
            "and e.period_end_date between coalesce(bc.valid_from, date '0001-01-01') and "
            "coalesce(bc.valid_to, date '9999-12-31')"))},
    "open_deal_base": """
        select cast(date_trunc('month', o.close_date) as date) close_month, o.fund_id,
               f.name fund_name, coalesce(c.region, 'Unknown Region') region,
               coalesce(bc.country_code, 'UNKNOWN') country_code,
               coalesce(c.name, 'Unknown Country') country_name,
               coalesce(bi.industry_id, 'UNKNOWN') industry_id,
               coalesce(d.name, 'Unknown Industry') industry_name, s.stage_id,
               s.name stage_name,
               sum(cast(o.amount * cast(coalesce(bc.allocation_pct, 100) / 100
                                        as decimal(5,4)) as decimal(38,10)))
                   pipeline_value_usd
        from dim_opportunities o
        join dim_funds f on f.fund_id = o.fund_id
        join dim_stages own on own.stage_id = o.stage_id
        join dim_stages s on s."order" <= own."order"
        left join br_opportunity_countries bc on bc.opportunity_id = o.opportunity_id
        left join dim_countries c on c.country_iso2_code = bc.country_code
        left join br_opportunity_industries bi on bi.opportunity_id = o.opportunity_id
             and bi.primary_flag is distinct from false
        left join dim_industries d on d.industry_id = bi.industry_id
        where o.close_date is not null
          and own.name not in ('Declined', 'Committed') and s.name not in ('Declined', 'Committed')
        group by all""",
    "months": f"select cast({FIRST} + to_months(cast(n as int)) as date) exposure_month "
              "from range(13) r(n)",
    "deal_months": """
        select m.exposure_month, k.*, coalesce((
            select sum(p.pipeline_value_usd) from open_deal_base p
            where p.fund_id = k.fund_id and p.country_code = k.country_code
              and p.industry_id = k.industry_id and p.stage_id = k.stage_id
              and p.region = k.region and p.close_month <= m.exposure_month), 0) closed
        from months m, (select distinct * exclude (close_month, pipeline_value_usd)
                        from open_deal_base) k""",
    "metrics_exposure_timeseries": f"""
        select exposure_month, year(exposure_month) exposure_year,
               month(exposure_month) exposure_month_num, fund_id, fund_name, instrument_type,
               region, country_code, country_name, industry_id, industry_name, maturity_year,
               security_rank, null stage_id, null stage_name,
               deployed_capital_usd, 0 closed_pipeline_usd,
               deployed_capital_usd total_exposure_usd,
               if(exposure_month = {FIRST}, 'Current', 'Forecast') period_type, as_of_date
        from deployed_base, months
        union all
        select exposure_month, year(exposure_month), month(exposure_month), fund_id, fund_name,
               null, region, country_code, country_name, industry_id, industry_name, null, null,
               stage_id, stage_name, 0, closed, closed,
               if(exposure_month = {FIRST}, 'Current', 'Forecast'), null
        from deal_months""",

    # --- summary marts -------------------------------------------------------
    "metrics_fund_performance_latest": f"""
        select *, cast(total_distributed_capital as double) / nullif(total_called_capital, 0) dpi,
               cast(current_nav + total_distributed_capital as double)
                   / nullif(total_called_capital, 0) tvpi,
               current_nav unrealized_value, total_distributed_capital realized_value,
               total_committed_capital - total_called_capital remaining_commitment,
               'ADMIN, PM' source_systems
        from (select f.fund_id, f.name fund_name, f.type fund_type, f.vintage,
                     f.base_currency_code,
                     coalesce((select max(n.period_end_date) from newest_snapshots n
                               join dim_instruments h using (instrument_id)
                               where h.fund_id = f.fund_id), {TODAY}) as_of_date,
                     coalesce((select sum(original_amount) from dim_commitments k
                               where k.fund_id = f.fund_id), 0) total_committed_capital,
                     coalesce((select sum(amount_converted) from fct_transactions t
                               where t.fund_id = f.fund_id and transaction_type = 'DRAWDOWN'), 0)
                         total_called_capital,
                     coalesce((select sum(amount_converted) from fct_transactions t
                               where t.fund_id = f.fund_id
                                 and transaction_type = 'DISTRIBUTION'), 0)
                         total_distributed_capital,
                     coalesce((select sum(n.fair_value_converted) from newest_snapshots n
                               join dim_instruments h using (instrument_id)
                               where h.fund_id = f.fund_id), 0) current_nav
              from dim_funds f)""",
    "metrics_pipeline_by_stage": f"""
        select o.fund_id, f.name fund_name, o.stage_id, s.name stage_name,
               s."order" stage_order, count(*) deal_count,
               coalesce(sum(o.amount), 0) total_amount_usd,
               cast(sum(o.amount) as double) / count(o.amount) avg_deal_size_usd,
               max({TODAY} - cast(o.created_at as date)) oldest_deal_days,
               min({TODAY} - cast(o.created_at as date)) newest_deal_days,
               'CRM' source_system, {TODAY} as_of_date
        from dim_opportunities o, dim_funds f, dim_stages s
        where o.fund_id = f.fund_id and o.stage_id = s.stage_id
          and s.name not in ('Declined', 'Committed')
        group by all""",
    "fund_preference": """
        select company_id, fund_id from deployed_by_instrument group by company_id, fund_id
        qualify row_number() over (partition by company_id
                                   order by sum(exposure_usd) desc, fund_id) = 1""",
    "metrics_company_financials_trend": """
        select r.company_id, c.name company_name, p.fund_id, f.name fund_name, r.period_end_date,
               year(r.period_end_date) period_year, quarter(r.period_end_date) period_quarter,
               r.revenue revenue_usd, r.ebitda ebitda_usd, r.net_income net_income_usd,
               cast(r.ebitda as double) / nullif(r.revenue, 0) * 100 ebitda_margin_pct,
               cast(r.revenue - b.revenue as double) / nullif(b.revenue, 0) * 100
                   revenue_growth_pct,
               cast(r.ebitda - b.ebitda as double) / nullif(b.ebitda, 0) * 100 ebitda_growth_pct,
               (select arg_max(v.amount, v.period_end_date) from fct_company_valuations v
                where v.company_id = r.company_id and v.valuation_type = 'ACTUAL')
                   current_valuation_usd, 'PM' source_system
        from fct_company_financials r
        join dim_companies c on c.company_id = r.company_id
        left join fct_company_financials b on b.company_id = r.company_id
             and b.period_end_date = (select max(x.period_end_date) from fct_company_financials x
                                      where x.company_id = r.company_id
                                        and x.period_end_date < r.period_end_date)
        left join fund_preference p on p.company_id = r.company_id
        left join dim_funds f on f.fund_id = p.fund_id""",
    "metrics_investment_activity_monthly": """
        select t.fund_id, f.name fund_name,
               cast(date_trunc('month', t.date) as date) activity_month, year(t.date) activity_year,
               quarter(t.date) activity_quarter, t.transaction_type, count(*) transaction_count,
               coalesce(sum(t.amount_converted), 0) total_amount_usd,
               string_agg(distinct t.source, ', ' order by t.source) source_systems
        from fct_transactions t join dim_funds f on f.fund_id = t.fund_id
        group by t.fund_id, f.name, activity_month, activity_year, activity_quarter,
                 t.transaction_type""",
    "metrics_loan_portfolio_summary": f"""
        select h.fund_id, f.name fund_name, year(l.maturity_date) maturity_year,
               count(*) loan_count,
               coalesce(sum(l.commitment_amount_converted), 0) total_commitment_usd,
               coalesce(sum(x.principal_outstanding_converted), 0) total_outstanding_usd,
               sum(coalesce(cast(l.fixed_rate_pct as double), l.spread_bps / 100.0::double)
                   * cast(x.principal_outstanding_converted as double))
                   / nullif(sum(x.principal_outstanding_converted) filter (
                       coalesce(l.fixed_rate_pct, l.spread_bps) is not null), 0)
                   weighted_avg_rate_pct,
               sum(l.spread_bps * cast(x.principal_outstanding_converted as double))
                   / nullif(sum(x.principal_outstanding_converted) filter (
                       l.spread_bps is not null), 0) weighted_avg_spread_bps,
               cast(coalesce(sum(x.principal_outstanding_converted), 0) as double)
                   / nullif(sum(l.commitment_amount_converted), 0) * 100 utilization_pct,
               'PM' source_system, coalesce(max(x.period_end_date), {TODAY}) as_of_date
        from dim_instruments_credit l
        join dim_instruments h on h.instrument_id = l.instrument_id
                              and h.instrument_type = 'CREDIT'
        join dim_funds f on f.fund_id = h.fund_id
        left join newest_credit x on x.instrument_id = l.instrument_id
        where l.maturity_date is not null group by all""",
}
