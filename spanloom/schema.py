"""Types of the data model. Field order makes array_sort order spans by start, end, level, text, truncated."""

SPAN = "struct<start:int,end:int,level:string,text:string,truncated:boolean>"
VIOLATION = "struct<rule:string,level:string,text:string,start:int,end:int,fixed_start:int>"
ITEM = f"struct<kind:string,old:{SPAN},new:{SPAN},label_match:boolean,severity:double>"
LEVELS = ("L1", "L2", "L3", "L4", "L5", "L6", "L7")
#: Severity weights of the levels; an unknown level weighs 1.
WEIGHTS = {"L1": 0.3, "L2": 1.0, "L3": 1.0, "L4": 0.7, "L5": 0.8, "L6": 0.9, "L7": 0.5}
