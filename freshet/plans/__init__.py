"""Whole analyses: rain scaling, flow regeneration, effect decomposition, aridity, drought."""
