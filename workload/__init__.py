"""The library's queries over the synthetic test tables, with equivalent SQL for each."""
