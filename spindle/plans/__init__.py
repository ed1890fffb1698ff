"""End-to-end workload plans composed from spindle operators:

* :mod:`spindle.plans.clustering` — per-group centres (W1/W2)
* :mod:`spindle.plans.text_scoring` — multi-label text scoring (W3)
* :mod:`spindle.plans.risk` — weighted, selected, scaled risk model (W4)
* :mod:`spindle.plans.income` — mode-imputed census-style model (W5)
"""
