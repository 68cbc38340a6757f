"""When a question looks for faults in its input."""

#: Instead of True: the checks are part of the plan. Building it runs no job, the input is read as often as without
#: checks, and a fault fails the query when its result is read.
IN_PLAN = "in plan"
