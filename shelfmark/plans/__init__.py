"""Plans made from declarations: field rules, master schemas, the guarded SQL surface, the join builder."""
