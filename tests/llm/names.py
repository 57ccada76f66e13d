"""Column names that the operators use inside."""

CLASHING = (
    "row size draw target level source_size copy taken_times weight key words slot region rack c kept p_good lines "
    "node bucket root class_id text_key text_hash leak_id item_id id shared need h1 h2 place line"
).split()
