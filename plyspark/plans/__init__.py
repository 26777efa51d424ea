"""Plans: how operators are composed and executed -- the batch refresh
(``plyspark.plans.pipeline``) and the hot-key window strategy
(``plyspark.plans.skew``)."""
