"""tagloom: customer-profile tags as fused Spark DataFrame plans."""
