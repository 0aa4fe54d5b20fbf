"""Direction of every event kind of the catalogue: 1 speaks for a rise, -1 for a fall, 0 for neither."""

from __future__ import annotations

# Kinds with a direction; contrarian kinds count against the move they report.
RISE = """
golden_cross ma_bullish_cross ma_golden_cross above_ma_streak bullish_divergence oversold_streak oversold_exit
exited_upper_touch exited_above_upper entered_lower_touch entered_below_lower obv_ma_bullish_cross extreme_low
oversold_entry zero_cross_positive tk_bullish_cross cloud_breakout_above breakout_up hammer inverted_hammer
marubozu_bullish bullish_engulfing tweezer_bottom morning_star three_white_soldiers milestone_high_60 milestone_high_252
ratio_extreme_low yoy_high yoy_streak_up gross_margin_rising roe_high eps_turn_positive
macd_golden_cross rsi_oversold breakout_above_ma60 lead_macd_golden_cross fear_low_entry
entered_extreme_fear exited_extreme_fear leading_turning_up leading_streak_up exited_danger
strong_trend_start concentration_rising vwap_bullish_cross net_buy_streak momentum_down
""".split()
FALL = """
death_cross ma_bearish_cross ma_death_cross bearish_divergence overbought_streak overbought_exit
volatility_expansion entered_upper_touch entered_above_upper exited_lower_touch exited_below_lower obv_ma_bearish_cross extreme_high
overbought_entry zero_cross_negative tk_bearish_cross cloud_breakout_below breakdown shooting_star hanging_man
marubozu_bearish bearish_engulfing tweezer_top evening_star three_black_crows milestone_low_60 milestone_low_252 limit_near_alert
ratio_extreme_high entered_maintenance_low yoy_low yoy_streak_down gross_margin_falling debt_ratio_rising operating_cash_flow_negative
free_cash_flow_negative_streak eps_turn_negative macd_death_cross rsi_overbought breakdown_below_ma60 lead_macd_death_cross
fear_spike fear_high_entry entered_extreme_greed exited_extreme_greed leading_turning_down leading_streak_down
entered_warning entered_danger single_day_drop
concentration_decreasing vwap_bearish_cross net_sell_streak momentum_up per_negative
""".split()
SIGNS = {k: 1 for k in RISE} | {k: -1 for k in FALL}
