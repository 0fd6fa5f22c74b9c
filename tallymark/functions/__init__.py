"""Column expressions: banding, formulas, masking, aggregate builders."""
