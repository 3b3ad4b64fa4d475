"""The vocabulary of parliamentary transcripts that rules match against.

Lists keep their order wherever the first match wins.
"""

LEGISLATOR_ROLES = ("legislator", "chair")
NONLEGISLATOR_ROLES = (
    "minister",
    "minister_nominee",
    "minister_acting",
    "vice_minister",
    "prime_minister",
    "witness",
    "testifier",
    "expert_witness",
    "senior_bureaucrat",
    "other_official",
    "local_gov_head",
    "agency_head",
    "public_corp_head",
    "org_head",
    "mid_bureaucrat",
    "nominee",
    "military",
    "police",
    "financial_regulator",
    "audit_official",
    "election_official",
    "constitutional_court",
    "assembly_official",
    "independent_official",
    "private_sector",
    "research_head",
    "cultural_institution_head",
    "broadcasting",
    "cooperative_head",
)
NEUTRAL_ROLES = ("committee_staff", "other", "unknown")
GOVERNMENT_ROLES = ("minister", "minister_nominee", "minister_acting", "vice_minister", "prime_minister", "agency_head", "senior_bureaucrat", "mid_bureaucrat")
PANEL_ROLES = ("minister", "minister_acting", "minister_nominee")

TERMS = (16, 17, 18, 19, 20, 21, 22)
#: Term, first and last day.
TERM_DAYS = (
    (16, "2000-05-30", "2004-05-29"),
    (17, "2004-05-30", "2008-05-29"),
    (18, "2008-05-30", "2012-05-29"),
    (19, "2012-05-30", "2016-05-29"),
    (20, "2016-05-30", "2020-05-29"),
    (21, "2020-05-30", "2024-05-29"),
    (22, "2024-05-30", "2028-05-29"),
)
HEARING_TYPES = ("상임위원회", "국정감사", "인사청문특별위원회", "예산결산특별위원회", "국회본회의", "국정조사")
DIRECTIONS = ("question", "answer")
COMMITTEE_KEYS = (
    "foreign_affairs",
    "defense",
    "finance",
    "education",
    "education_science",
    "education_culture",
    "science_ict",
    "agriculture",
    "industry",
    "health_welfare",
    "environment_labor",
    "land_transport",
    "public_admin",
    "judiciary",
    "political_affairs",
    "assembly_operations",
    "intelligence",
    "gender_family",
    "culture",
    "culture_media",
    "other",
    "confirmation_special",
    "budget_special",
    "investigation",
    "plenary",
)
#: Raw name of a committee and its key.
COMMITTEES = (
    ("통일외교통상위원회", "foreign_affairs"),
    ("외교통상통일위원회", "foreign_affairs"),
    ("외교통일위원회", "foreign_affairs"),
    ("국방위원회", "defense"),
    ("재정경제위원회", "finance"),
    ("기획재정위원회", "finance"),
    ("교육위원회", "education"),
    ("교육과학기술위원회", "education_science"),
    ("교육문화체육관광위원회", "education_culture"),
    ("과학기술정보통신위원회", "science_ict"),
    ("미래창조과학방송통신위원회", "science_ict"),
    ("농림해양수산위원회", "agriculture"),
    ("농림수산식품위원회", "agriculture"),
    ("농림축산식품해양수산위원회", "agriculture"),
    ("산업자원위원회", "industry"),
    ("지식경제위원회", "industry"),
    ("산업통상자원위원회", "industry"),
    ("보건복지위원회", "health_welfare"),
    ("보건복지가족위원회", "health_welfare"),
    ("환경노동위원회", "environment_labor"),
    ("건설교통위원회", "land_transport"),
    ("국토해양위원회", "land_transport"),
    ("국토교통위원회", "land_transport"),
    ("행정자치위원회", "public_admin"),
    ("안전행정위원회", "public_admin"),
    ("행정안전위원회", "public_admin"),
    ("법제사법위원회", "judiciary"),
    ("정무위원회", "political_affairs"),
    ("국회운영위원회", "assembly_operations"),
    ("정보위원회", "intelligence"),
    ("여성위원회", "gender_family"),
    ("여성가족위원회", "gender_family"),
    ("문화관광위원회", "culture"),
    ("문화체육관광위원회", "culture"),
    ("문화체육관광방송통신위원회", "culture_media"),
)
SPEECH_COLUMNS = ("meeting_id", "term", "committee", "committee_key", "hearing_type", "date", "agenda", "speaker", "member_id", "speech_order", "role", "person_name", "affiliation_raw", "speech_text")
DYAD_COLUMNS = ("meeting_id", "term", "committee", "committee_key", "hearing_type", "date", "agenda", "leg_name", "leg_speaker_raw", "witness_name", "witness_speaker_raw", "witness_role", "witness_affiliation", "direction", "leg_speech", "witness_speech")

BLANKS = ("", "nan", "None", "NaN", "0", "<NA>")
PERSON_TITLES = ("대리", "반장", "직무대리", "직무대행", "반장대리", "반장직무대행", "반장직무대리", "위원장대리", "위원당대리")

#: Prefix of a name, and the title that it stands for.
TITLE_PREFIXES = (
    ("반장직무대행", "반장직무대행"),
    ("반장직무대리", "반장직무대리"),
    ("반장대리", "반장대리"),
    ("직무대행", "직무대행"),
    ("직무대리", "직무대리"),
    ("위원당대리", "위원당대리"),
    ("위윈장대리", "위원장대리"),
    ("대리위", "대리"),
    ("대리", "대리"),
    ("반장", "반장"),
)
NAME_SUFFIXES = ("의원", "위원님")

#: Role, keyword, where the person's name is, what the affiliation is.
SPEAKER_RULES = (
    ("chair", "위원장", "after", "whole"),
    ("legislator", "위원$", "without:위원", "whole"),
    ("legislator", "MEMBER", "whole", "whole"),
    ("minister_nominee", "장관후보자", "after", "before"),
    ("minister", "장관", "after", "before"),
    ("nominee", "총리.*후보자|후보자.*총리", "after:총리\\s*(후보자)?", "whole"),
    ("prime_minister", "총리", "after", "whole"),
    ("vice_minister", "차관", "after", "before"),
    ("witness", "증인", "without:증인", "none"),
    ("testifier", "진술인", "without:진술인", "none"),
    ("expert_witness", "참고인", "without:참고인", "none"),
    ("committee_staff", "전문위원", "after", "whole"),
    ("nominee", "후보자", "after", "before"),
    ("agency_head", "청장", "after", "whole"),
    ("audit_official", "감사원장|감사위원", "last", "whole"),
    ("constitutional_court", "헌법재판소", "last", "whole"),
    ("election_official", "선거관리위원회|선관위", "last", "whole"),
    ("assembly_official", "국회사무|국회도서관|국회예산정책처|국회입법조사처", "last", "whole"),
    ("senior_bureaucrat", "본부장|처장|사무처장|국장|실장|차장|총재|이사장", "last", "whole"),
    ("org_head", "원장|회장|사장", "last", "whole"),
)

#: The documented cascade over all roles, as SPEAKER_RULES; agency chairs, who are no legislators, come first.
SPEAKER_RULES_ALL = (
    ("independent_official", "(국사편찬|방송통신|공정거래|금융|국민권익|국가인권)위원장", "after", "whole"),
    ("chair", "위원장", "after", "whole"),
    ("legislator", "위원$", "without:위원", "whole"),
    ("legislator", "MEMBER", "whole", "whole"),
    ("minister_nominee", "장관후보자", "after", "before"),
    ("minister_acting", "장관직무대행|장관직무대리", "after", "before"),
    ("minister", "장관", "after", "before"),
    ("nominee", "총리.*후보자|후보자.*총리", "after:총리\\s*(후보자)?", "whole"),
    ("prime_minister", "총리", "after", "whole"),
    ("vice_minister", "차관", "after", "before"),
    ("witness", "증인", "without:증인", "none"),
    ("testifier", "진술인", "without:진술인", "none"),
    ("expert_witness", "참고인", "without:참고인", "none"),
    ("committee_staff", "전문위원", "after", "whole"),
    ("nominee", "후보자", "after", "before"),
    ("agency_head", "청장", "after", "whole"),
    ("audit_official", "감사원장|감사위원", "last", "whole"),
    ("constitutional_court", "헌법재판소", "last", "whole"),
    ("election_official", "선거관리위원회|선관위", "last", "whole"),
    ("assembly_official", "국회사무|국회도서관|국회예산정책처|국회입법조사처", "last", "whole"),
    ("military", "사령관|참모총장", "last", "whole"),
    ("police", "경찰", "last", "whole"),
    ("broadcasting", "방송공사|방송사|방송원", "last", "whole"),
    ("public_corp_head", "사장|은행장", "last", "whole"),
    ("financial_regulator", "금융감독원", "last", "whole"),
    ("research_head", "연구원장|연구소장", "last", "whole"),
    ("cultural_institution_head", "박물관장|미술관장|예술원장", "last", "whole"),
    ("cooperative_head", "조합장|중앙회장", "last", "whole"),
    ("org_head", "원장|회장", "last", "whole"),
    ("senior_bureaucrat", "본부장|처장|사무처장|국장|실장|차장|총재|이사장", "last", "whole"),
    ("mid_bureaucrat", "정책관|감사관", "last", "whole"),
    ("local_gov_head", "시장|도지사|군수|구청장|교육감", "last", "whole"),
    ("private_sector", "주식회사|㈜|대표이사", "last", "whole"),
    ("other_official", "보좌관|대변인|자문역|홍보관", "last", "whole"),
)

#: Pattern in a speaker's label, and the role of a speaker whose role is `other`.
OTHER_RULES = (
    ("사관학교장", "military"),
    ("사령관|참모총장|참모차장", "military"),
    ("경찰청|경찰서", "police"),
    ("교수|연구위원|연구원.*센터", "expert_witness"),
    ("감독$|선수단", "private_sector"),
    ("예술감독", "private_sector"),
    (r"국장$|국장\s", "senior_bureaucrat"),
    (r"실장$|실장\s", "senior_bureaucrat"),
    (r"정책관$|정책관\s", "mid_bureaucrat"),
    (r"감사관$|감사관\s", "mid_bureaucrat"),
    (r"교육장\s|교육장$", "local_gov_head"),
    (r"관장\s|관장$", "org_head"),
    (r"소장\s|소장$", "org_head"),
    (r"상임위원\s|상임위원$", "org_head"),
    ("전무이사|상무이사|기획이사|사업이사|관리이사|운영이사|기금이사|보험관리이사|업무이사|업무상임이사|유통이사|유통담당이사|검정이사|자격검정이사|기반조성본부이사|유지관리본부이사|기획운영이사|선임비상임이사|관리상임이사", "org_head"),
    (r"이사\s|이사$", "org_head"),
    (r"감사\s|감사$", "org_head"),
    ("통제소장", "senior_bureaucrat"),
)
OTHER_RULES_MORE = (
    ("기무사령부|기무부대", "military"),
    ("군사보좌관", "military"),
    ("금융통화위원", "financial_regulator"),
    ("한국정책방송원|KBS|방송통신위원회", "broadcasting"),
    ("방송위원회", "broadcasting"),
    (r"교육장$|교육장\s", "local_gov_head"),
    (r"학교장\s|학교장$", "org_head"),
    ("맹학교장|고등학교장|중학교장", "org_head"),
    ("정책보좌관|정치자문역|자문역", "other_official"),
    (r"보좌관\s|보좌관$", "other_official"),
    (r"홍보관\s|홍보관$", "other_official"),
    (r"대변인\s|대변인$", "other_official"),
    ("제작소장|자원관장", "org_head"),
    (r"공사.*팀\s|공사.*부\s", "org_head"),
    (r"워킹그룹.*관\s|워킹그룹.*관$", "other_official"),
    (r"연구부\s|연구부$", "expert_witness"),
    (r"교수\s|교수$", "expert_witness"),
    (r"안전평가관\s|안전평가관$", "mid_bureaucrat"),
    (r"어업자원관\s|어업자원관$", "mid_bureaucrat"),
    (r"노사협력관\s|노사협력관$", "mid_bureaucrat"),
    (r"선진화관\s|선진화관$", "mid_bureaucrat"),
    (r"정책과\s|정책과$", "mid_bureaucrat"),
    (r"TF장\s|TF장$", "mid_bureaucrat"),
    ("소방서|안전센터", "police"),
    ("대통령직인수위원회위원", "assembly_official"),
    (r"㈜|주식회사|\(재\)|\(사\)", "private_sector"),
    (r"선수단감독|감독\s", "private_sector"),
    ("철인3종|트라이애슬론", "private_sector"),
)

#: Pattern in a speaker's label, and the role that an audit suggests for a speaker whose role is `other`.
SUGGESTED_ROLES = (
    ("^(?:[^후]|후[^보]|후보[^자])*장관(?:[^후]|후[^보]|후보[^자])*$", "minister"),
    ("위원장", "chair"),
    ("차관", "vice_minister"),
    ("청장", "agency_head"),
    ("원장|회장", "org_head"),
    ("사장", "public_corp_head"),
    ("교수", "expert_witness"),
    ("위원$", "expert_witness"),
    ("이사", "org_head"),
    ("감독|선수", "private_sector"),
    ("국장|실장", "senior_bureaucrat"),
)
#: Words in the names of subcommittees.
SUBCOMMITTEE = "소위|예결|법안심사|인사청문"

#: member_id, naas_cd and the id that tells the two people apart.
HOMONYMS = (
    ("7407", "E6S73230", "7407_A"),
    ("7407", "0W194007", "7407_B"),
    ("6182", "FJ03481D", "6182_A"),
    ("6182", "KA04352K", "6182_B"),
    ("806", "ZC87486D", "806_A"),
    ("806", "DTG4846A", "806_B"),
    ("878", "BQS2021C", "878_A"),
    ("878", "9UW75767", "878_B"),
)

#: Pattern and replacement, in order, that reduce a title to its ministry.
MINISTRY_STEPS = (
    (r"^보\s+(\S+부|국방부)$", "1"),
    (r"^보\s+(\S+부)\S*$", "1"),
    (r"^부[총홍]리겸", ""),
    (r"^정책보좌관\s+(\S+)$", "1"),
    (r"장관(후보자|직무대행|직무대리|정책보좌관)?(\s+\S+)?$", ""),
    (r"차관(보)?(\s+\S+)?$", ""),
    (r"제[12](차관.*)?$", ""),
    (r"[12]차관.*$", ""),
    (r"2$", ""),
    (r"차관(보)?$", ""),
    (r"^실\S*\s+(.+)$", "1"),
    (r"^\S+관\s+(\S+부)$", "1"),
    (r"^\S+국장\s+(\S+부)$", "1"),
    (r"(처|청|원|실|본부)장\s+\S+$", "1"),
    (r"^(서울|부산|대구|인천|광주|대전|울산|세종|경기|강원|충북|충남|전북|전남|경북|경남|제주)\S*(지방|유역)", ""),
    (r"^(서울|부산|대구|인천|광주|대전|울산|세종)\S*지방", ""),
)
MINISTRY_GARBAGE = "^리[공실본부팀]|^후보장|^후보 "
MINISTRY_REJECT = "공사|보험|부동산원|㈜|은행총재|한국은행"
MINISTRY_ENDINGS = "(부|처|청|원|총리|장관|통상|본부|실)$"
MINISTRY_TYPOS = (
    ("법부무", "법무부"),
    ("범무부", "법무부"),
    ("법무무", "법무부"),
    ("행장자치부", "행정자치부"),
    ("안정행정부", "안전행정부"),
    ("안전행전부", "안전행정부"),
    ("해앙수산부", "해양수산부"),
    ("해수부", "해양수산부"),
    ("정통부", "정보통신부"),
    ("교육적인자원부", "교육인적자원부"),
    ("교육인적자부", "교육인적자원부"),
    ("재정경재부", "재정경제부"),
    ("문환관광부", "문화관광부"),
    ("문화관부", "문화관광부"),
    ("교육기술부", "교육과학기술부"),
    ("교육과술부", "교육과학기술부"),
    ("교육과학기술기술부", "교육과학기술부"),
    ("문화체육광부", "문화체육관광부"),
    ("과학기술정보통부", "과학기술정보통신부"),
    ("농림축신식품부", "농림축산식품부"),
    ("농림축삭식품부", "농림축산식품부"),
    ("농림수산식품", "농림수산식품부"),
    ("산업지원부", "산업자원부"),
    ("산업자원통상부", "산업통상자원부"),
    ("여성가족주", "여성가족부"),
    ("통상외교부", "외교통상부"),
    ("해농림부", "농림부"),
    ("여성부가족부", "여성가족부"),
    ("여성부가족", "여성가족부"),
    ("보건복지부가족부", "보건복지부"),
    ("보건복지부보건복지부", "보건복지부"),
    ("보건복지부보", "보건복지부"),
    ("국방", "국방부"),
    ("과학기술", "과학기술부"),
    ("부총리겸교육적인자원부", "교육인적자원부"),
    ("농림수산식품부제", "농림수산식품부"),
    ("행정자치부장관후", "행정자치부"),
    ("행정자치부장관", "행정자치부"),
    ("재경경제부제1", "재정경제부"),
    ("재경부", "재정경제부"),
    ("재정경제", "재정경제부"),
    ("행전안전부제1", "행정안전부"),
    ("문화관광체육부제1", "문화체육관광부"),
    ("문화체육부제1", "문화체육관광부"),
    ("부총리겸재정경재부", "재정경제부"),
    ("부홍리겸재정경제부", "재정경제부"),
)
MINISTRY_HISTORY = (("여성부", "여성가족부"), ("보건복지가족부", "보건복지부"), ("특임", "특임장관"))
NAME_TYPOS = (("졍종환", "정종환"), ("백영희", "백희영"), ("윤관웅", "윤광웅"))

#: Administration, ideology as documented, first and last day.
ADMINISTRATIONS = (
    ("김대중", "Progressive", "1998-02-25", "2003-02-24"),
    ("노무현", "Progressive", "2003-02-25", "2008-02-24"),
    ("이명박", "Conservative", "2008-02-25", "2013-02-24"),
    ("박근혜", "Conservative", "2013-02-25", "2017-03-10"),
    ("문재인", "Progressive", "2017-05-10", "2022-05-09"),
    ("윤석열", "Conservative", "2022-05-10", "2025-06-03"),
    ("이재명", "Progressive", "2025-06-04", "2099-12-31"),
)
